"""Mixing sources to target weights by iterative proportional fitting.

``cells`` sums tokens by source, language and topic; ``rake`` scales the cells' weights until their sums by
source, by language and by topic meet the targets; ``mix`` gives every document its cell's factor (calibrated weight over
natural weight) and samples documents by a hash of the identifier, so that reruns and retries choose the same documents.

The sample has ``floor(rate * factor)`` copies of a document and one more with the fraction that is left as probability: the
expected tokens of every cell are ``rate`` times its weight, also where the factor is above 1. ``mix`` and ``copies`` report the
copies of every document, ``counted`` and ``sampled`` return the sample's documents.

Targets: for each margin either an exponent (target share in proportion to ``natural share ** exponent``; 1 keeps the
natural shares, 0 makes them equal) or a dict of shares by value, where values that are not named get none.

Scale: documents are pre-aggregated to cells before any shuffle. The cells come back from a written table,
whose size Spark knows: below its broadcast limit they are sent to the documents, beyond it both sides are shuffled and hot
keys split by the skew join. Up to ``ONE_TASK_CELLS`` counted cells are raked in one task without any shuffle; more of them by
windows over hash partitions, with the same arithmetic.

Only DataFrame and SQL functions are used.

Defined cases: null source, language or topic is a value of its own; a null or empty text has no tokens (factor of its
cell, 0 if the whole cell has no tokens); repeated rows count each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import materialise

MARGINS = ("source", "lang", "topic")
#: production parameters
EXPONENTS: dict[str, float | dict[str, float]] = {"source": 0.7, "lang": 0.7, "topic": 0.7}
ROUNDS, RATE, SEED = 12, 1.0, "mix-1"
ONE_TASK_CELLS = 200_000


def topic_of(text: Column) -> Column:
    """A topic from marks in the text, for tables that have no topic column."""
    return (
        F.when(text.contains("License"), "legal")
        .when(text.contains(" | "), "table")
        .when(text.contains("!!") | text.contains("%%%") | text.contains("###"), "noise")
        .otherwise("prose")
    )


def tokens_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def described(docs: DataFrame, text_col: str = "text", topic: Column | None = None) -> list[Column]:
    """The columns that the operator adds to a document: margins and tokens, under names of its own."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    topic = topic_of(text) if topic is None else topic
    return [F.col("source").alias("_source"), F.col("lang").alias("_lang"), topic.alias("_topic"), tokens_of(text).alias("_tokens")]


def cells(docs: DataFrame, text_col: str = "text", topic: Column | None = None) -> DataFrame:
    """One row per combination of margins: source, lang, topic, tokens. Summed in each task before the shuffle."""
    rows = docs.select(described(docs, text_col, topic))
    return rows.groupBy([F.col(f"_{m}").alias(m) for m in MARGINS]).agg(F.sum("_tokens").alias("tokens"))


def rake(table: DataFrame, targets: dict[str, float | dict[str, float]] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """The cells with ``weight`` (sums to all tokens, meets the margins' targets) and ``factor`` (weight over tokens)."""
    targets = targets or EXPONENTS
    # written: counted once, read again by each step
    table = materialise(table, "mixing-cells")
    count, total = table.agg(F.count(F.lit(1)), F.sum("tokens").cast("double")).first()
    total = total or 0.0
    if count <= ONE_TASK_CELLS:
        table = table.repartition(1)
    frame = table.withColumn("weight", F.col("tokens").cast("double"))
    for m in MARGINS:
        wanted = targets[m]
        if isinstance(wanted, dict):
            # a share per named value; equal to a literal, so the table of shares stays in the plan
            share = F.lit(0.0)
            for value, s in wanted.items():
                share = F.when(F.col(m).eqNullSafe(F.lit(value)), float(s)).otherwise(share)
            norm = sum(map(float, wanted.values()))
        else:
            sums = table.groupBy(m).agg(F.sum("tokens").cast("double").alias("s"))
            norm = sums.agg(F.sum(F.pow("s", F.lit(float(wanted))))).first()[0]
            share = F.pow(F.sum("tokens").over(Window.partitionBy(m)).cast("double"), F.lit(float(wanted)))
        frame = frame.withColumn(f"target_{m}", share * F.lit(total) / F.lit(float(norm or 1.0)))
    for _ in range(rounds):
        for m in MARGINS:
            have = F.sum("weight").over(Window.partitionBy(m))
            frame = frame.withColumn("weight", F.when(have > 0, F.col("weight") * F.col(f"target_{m}") / have).otherwise(0.0))
    factor = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    return materialise(frame.select(*MARGINS, "tokens", "weight", factor.alias("factor")), "mixing-factors")


def uniform(identifier: Column, seed: str) -> Column:
    """A number in [0, 1) from the identifier, equal on every run."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(identifier.cast("string"), F.lit("null")))), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**12))


def weighted(docs: DataFrame, targets: dict | None = None, rounds: int = ROUNDS, rate: float = RATE, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", topic: Column | None = None) -> DataFrame:
    """``row`` (the row of ``docs``, whatever its columns are called) with ``_source``, ``_lang``, ``_topic``, ``_tokens``, ``_factor``, ``_copies``."""
    factors = rake(cells(docs, text_col, topic), targets, rounds).select([F.col(m).alias(f"c_{m}") for m in MARGINS] + [F.col("factor").alias("_factor")])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *described(docs, text_col, topic))
    # every document has its cell; equality of nulls included
    on = F.lit(True)
    for m in MARGINS:
        on = on & F.col(f"_{m}").eqNullSafe(F.col(f"c_{m}"))
    joined = rows.join(factors, on).drop(*[f"c_{m}" for m in MARGINS])
    # rounded, so that the order of a sum decides nothing
    wanted, draw = F.round(F.lit(float(rate)) * F.col("_factor"), 9), uniform(F.col("row").getField(id_col), seed)
    return joined.withColumn("_copies", F.floor(wanted) + (draw < wanted - F.floor(wanted)).cast("long"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, n_tokens, factor (six decimals), n_copies, sampled (if there are any)."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    out = weighted(docs.select(id_col, text_col, "source", "lang"), **options)
    return out.select(
        F.col("row").getField(id_col).alias("doc_id"),
        F.col("_source").alias("source"),
        F.col("_lang").alias("lang"),
        F.col("_topic").alias("topic"),
        F.col("_tokens").alias("n_tokens"),
        F.round("_factor", 6).alias("factor"),
        F.col("_copies").alias("n_copies"),
        (F.col("_copies") > 0).alias("sampled"),
    )


def copies(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, n_tokens, factor (not rounded), n_copies (how often the sample has it)."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    out = weighted(docs.select(id_col, text_col, "source", "lang"), **options)
    return out.select(
        F.col("row").getField(id_col).alias("doc_id"),
        F.col("_source").alias("source"),
        F.col("_lang").alias("lang"),
        F.col("_topic").alias("topic"),
        F.col("_tokens").alias("n_tokens"),
        F.col("_factor").alias("factor"),
        F.col("_copies").alias("n_copies"),
    )


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col("row").getField(c).alias(c) for c in docs.columns]


def counted(docs: DataFrame, **options) -> DataFrame:
    """The documents of the sample once each, with the columns they came with and ``n_copies`` (which takes the place of one of that name)."""
    columns = [c for c, name in zip(_columns(docs), docs.columns, strict=True) if name != "n_copies"]
    return weighted(docs, **options).where("_copies > 0").select(*columns, F.col("_copies").alias("n_copies"))


def sampled(docs: DataFrame, **options) -> DataFrame:
    """The sample, each document as often as it has copies, with the columns they came with."""
    chosen = weighted(docs, **options).where("_copies > 0")
    return chosen.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(_columns(docs))
