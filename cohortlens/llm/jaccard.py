"""N-gram Jaccard join with set relations: which documents have nearly the same shingles.

A document's set holds its distinct shingles of ``WORDS`` words, as 64-bit fingerprints. Shingles are ordered
by how many documents have them (power of two), then by value; two sets can only reach the threshold if they share a shingle
among the first ``n - ceil(0.85 n) + 1`` of each (prefix). Most prefixes consist of shingles that no other document
has; those documents are done. The others join by index lists (prefix shingle: documents, set sizes, positions):

* equal sets are one class, answered once (set relation: identity);
* index lists are skipped by position: an entry is passed over if the sizes, or what is left of both sets from
  the shared position on, cannot reach the threshold;
* answers are derived incrementally: every list's sets are first compared with one leading set only. Sets
  that a component already holds together need no further comparison. What is left, components that share a list but no link, is compared
  block by block, the shingles of a block of sets serving as one index for the other component's sets.

All links between different components are tried, so components are exact.

Defined cases: null or empty texts and texts without words have an empty set and link with nothing; with fewer
words than ``WORDS`` the whole sequence is one shingle; a null identifier links with nothing; links are between sets, not
identifiers: rows that repeat an identifier have the component of their own set each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.session import materialise

from . import packed as P
from .common import map_arrow
from .components import components

WORDS, PERCENT = 4, 85
#: sets per row when two components are compared
SET_BLOCK = 64

U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=U64)


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """The distinct shingles of each text, sorted, as 64-bit fingerprints."""
    raw = [t.encode("utf-8").lower() for t in texts]  # bytes: A-Z only
    buffer = np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw])
    space = _SPACE[buffer]
    before = np.concatenate([[True], space[:-1]])
    starts = np.flatnonzero(~space & before)
    stops = np.flatnonzero(space & ~before)
    rolling = P.rolling()
    word = rolling.of(rolling.sums(buffer), starts, stops)
    first = np.searchsorted(starts, np.concatenate([[0], ends]))  # first word of each text
    factors = _FACTORS[np.arange(words) % len(_FACTORS)] + U64(2) * (np.arange(words, dtype=U64) // U64(len(_FACTORS)))
    whole = np.zeros(max(0, len(word) - words + 1), dtype=U64)
    for j in range(words):
        whole += word[j : j + len(whole)] * factors[j]
    whole = P.mix(whole)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= words:
            out.append(np.unique(whole[a : b - words + 1]))
        elif b > a:
            short = np.sum(word[a:b] * factors[: b - a], dtype=U64) + U64(b - a)
            out.append(P.mix(np.array([short], dtype=U64)))
        else:
            out.append(np.zeros(0, dtype=U64))
    return out


def _block_keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, U64), np.zeros(0, int))


def _frequency(bucket: int, parts: list[bytes], counts: list[np.ndarray]) -> np.ndarray:
    """0: one document has the shingle; else the number of documents as a power of two, rounded up, 15 at most."""
    return P.judged(_levels, parts, counts, P.NARROW)


def _levels(keys: np.ndarray, flags: np.ndarray) -> np.ndarray:
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    begins = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    total = np.add.reduceat(flags[order].astype(np.int64), begins)
    level = np.minimum(np.ceil(np.log2(total)), 15).astype(np.uint8)
    out = np.empty(len(keys), np.uint8)
    out[order] = np.repeat(level, np.diff(np.append(begins, len(keys))))
    return out


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def text_mark() -> Column:
    """Tells rows apart that repeat an identifier in different texts."""
    return F.xxhash64("text")


def prepared(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, the mark of its text, n, the fingerprint of its set, the shared shingles of its prefix with positions,
    its set if there are any."""
    buckets = P.shuffle_parts(docs.sparkSession)
    table = P.blocks(docs.select("doc_id", "text", text_mark().alias("mark")), "jaccard", carry=True)

    def ask(row: dict) -> Iterator[dict]:
        keys, counts = _block_keys(shingle_sets(row["texts"], words))
        yield from P.question_rows(row["block"], keys, counts, buckets)

    answers = P.answer(P.each_block(table, ask, P.QUESTION), _frequency)

    def rows(row: dict) -> Iterator[dict]:
        sets = shingle_sets(row["texts"], words)
        keys, _ = _block_keys(sets)
        levels = P.answers_of(row["answers"], keys, buckets)
        for doc_id, old, own in zip(row["doc_ids"], row["rows"], sets, strict=True):
            n = len(own)
            out = {"doc_id": doc_id, "mark": old["mark"], "n": n, "print_a": None, "print_b": None, "tokens": [], "places": [], "shingles": b""}
            if n:
                level = levels[np.searchsorted(keys, own)]
                order = np.lexsort((own, level))[: prefix_length(n, percent)]
                shared = level[order] > 0
                out["print_a"] = int(np.sum(own * _FACTORS[0] ^ own >> U64(29), dtype=U64).view(np.int64))
                out["print_b"] = int(np.sum(P.mix(own ^ _FACTORS[1]), dtype=U64).view(np.int64))
                if shared.any():
                    out["tokens"] = own[order][shared].view(np.int64).tolist()
                    out["places"] = np.flatnonzero(shared).tolist()
                    out["shingles"] = own.tobytes()
            yield out

    schema = "doc_id long, mark long, n long, print_a long, print_b long, tokens array<long>, places array<int>, shingles binary"
    return materialise(P.each_block(P.with_answers(table, answers), rows, schema), "jaccard-sets")


def _can_reach(na: Column, nb: Column, pa_: Column, pb: Column, percent: int) -> Column:
    """Sizes and what is left from the shared positions on allow the threshold."""
    small, large = F.least(na, nb), F.greatest(na, nb)
    most = F.least(na - pa_, nb - pb)  # the shared shingle and all after it
    # 100 i >= p u with u = na + nb - i  <=>  (100 + p) i >= p (na + nb)
    return (100 * small >= percent * large) & ((100 + percent) * most >= percent * (na + nb))


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, set_a, set_b = (batch.column(n).to_pylist() for n in ("a", "b", "set_a", "set_b"))
            hit = []
            for x, y in zip(set_a, set_b, strict=True):
                x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                hit.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = [i for i, h in enumerate(hit) if h]
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], names=["a", "b"])

    return map_arrow(pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b"), check, "a long, b long")


def _apart(lists: DataFrame, named: DataFrame, percent: int) -> DataFrame:
    """Pairs of components (host, guest) that share an index list in which some of their sets could reach the threshold.

    The host is the component with more sets (by name, if equal).
    """
    labelled = lists.join(named.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("label", F.coalesce("component", "doc_id"))
    parts = labelled.groupBy("token", "label").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("n") - F.col("place")).alias("rest"))
    mixed = parts.groupBy("token").agg(F.count(F.lit(1)).alias("labels")).where("labels > 1").select("token")
    parts = materialise(parts.join(mixed, "token"), "jaccard-mixed-lists")
    one, two = parts.alias("x"), parts.alias("y")
    met = one.join(two, (F.col("x.token") == F.col("y.token")) & (F.col("x.label") < F.col("y.label")))
    met = met.where(
        (100 * F.col("x.high") >= percent * F.col("y.low"))
        & (100 * F.col("y.high") >= percent * F.col("x.low"))
        & ((100 + percent) * F.least("x.rest", "y.rest") >= percent * (F.col("x.low") + F.col("y.low")))
    )
    met = met.select(F.col("x.label").alias("x"), F.col("y.label").alias("y")).distinct()
    sizes = named.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    met = met.join(sizes.select(F.col("component").alias("x"), F.col("size").alias("sx")), "x", "left").join(sizes.select(F.col("component").alias("y"), F.col("size").alias("sy")), "y", "left")
    swap = F.coalesce("sy", F.lit(1)) > F.coalesce("sx", F.lit(1))
    return materialise(met.select(F.when(swap, F.col("y")).otherwise(F.col("x")).alias("host"), F.when(swap, F.col("x")).otherwise(F.col("y")).alias("guest")), "jaccard-apart")


def _between(apart: DataFrame, named: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """One link (a, b) for each block of a host and each guest with sets in it that reach the threshold.

    A row holds a block of a host's sets and a block of its guests' sets, so neither side of a pair grows with its component.
    """
    labelled = sets.join(named.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(F.coalesce("component", "doc_id").alias("label"), "doc_id", "shingles")

    def in_blocks(rows: DataFrame) -> DataFrame:
        """(host, block, sets) from rows (host, label, doc_id, shingles); the rows of a host are dealt by block, not by host."""
        sizes = rows.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / F.lit(SET_BLOCK)).alias("blocks"))
        spread = rows.join(sizes, "host").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
        blocks = spread.repartition("host", "block").groupBy("host", "block").agg(F.collect_list(F.struct("label", "doc_id", "shingles")).alias("sets"))
        return materialise(blocks, "jaccard-set-blocks")

    hosts = in_blocks(labelled.join(apart.select("host").distinct(), labelled.label == F.col("host")).select("host", "label", "doc_id", "shingles"))
    guests = in_blocks(labelled.join(apart, labelled.label == F.col("guest")).select("host", "label", "doc_id", "shingles"))

    def compare(row: dict) -> Iterator[dict]:
        owns = [np.frombuffer(s["shingles"], U64) for s in row["sets"]]
        sizes = np.array([len(o) for o in owns])
        index = np.concatenate(owns)
        order = np.argsort(index, kind="stable")
        index, owner = index[order], np.repeat(np.arange(len(owns)), sizes)[order]
        linked = set()
        for guest in row["guests"]:
            if guest["label"] in linked:
                continue  # answered: the two components are one
            own = np.frombuffer(guest["shingles"], U64)
            lo, hi = np.searchsorted(index, own, "left"), np.searchsorted(index, own, "right")
            runs = hi - lo
            at = np.repeat(lo - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs) + np.arange(runs.sum())
            both = np.bincount(owner[at], minlength=len(owns))
            hit = np.flatnonzero(100 * both >= percent * (sizes + len(own) - both))
            if len(hit):
                linked.add(guest["label"])
                yield {"a": row["sets"][hit[0]]["doc_id"], "b": guest["doc_id"]}

    # every pair of a host's block and a guests' block is a key of its own: a large component is as many tasks as it has pairs
    pairs = hosts.select("host", "block").join(guests.select("host", F.col("block").alias("guest_block")), "host")
    own = hosts.join(pairs, ["host", "block"])
    visitors = guests.select("host", F.col("block").alias("guest_block"), F.col("sets").alias("guests"))
    together = own.repartition("host", "guest_block", "block").join(visitors.join(pairs, ["host", "guest_block"]), ["host", "block", "guest_block"]).select("sets", "guests")
    return P.each_block(together, compare, "a long, b long")


def _classes(table: DataFrame, percent: int) -> DataFrame:
    """One row per distinct set: its fingerprint (n, print_a, print_b), ``node`` (its number), ``first`` (smallest identifier with it)
    and ``component`` (the smallest node reachable by links)."""
    same = ["n", "print_a", "print_b"]
    # equal sets: one class, answered by a row with its smallest identifier
    sized = table.where("n > 0 and doc_id is not null").groupBy(same).agg(F.min("doc_id").alias("first"))
    classes = materialise(sized.withColumn("node", F.monotonically_increasing_id()), "jaccard-classes")
    # from here on a set goes by its number
    answering = table.where("size(tokens) > 0").join(classes.withColumnRenamed("first", "doc_id"), ["doc_id", *same]).dropDuplicates(["node"]).drop("doc_id").withColumnRenamed("node", "doc_id")
    lists = answering.select("doc_id", "n", F.element_at("places", 1).alias("own"), F.explode(F.arrays_zip("tokens", "places")).alias("t")).select("doc_id", "n", "own", F.col("t.tokens").alias("token"), F.col("t.places").alias("place"))
    lists = materialise(lists, "jaccard-lists")
    sets = answering.select("doc_id", "shingles")
    # a list's leader has the fewest shingles of its own: what the others were copied from has none, and leads all its lists
    leaders = lists.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("own", "doc_id", "n", "place")).alias("lead")).where("size > 1").select(
        "token", F.col("lead.doc_id").alias("a"), F.col("lead.n").alias("na"), F.col("lead.place").alias("place_a")
    )
    led = lists.join(leaders, "token").where(F.col("doc_id") != F.col("a"))
    led = led.where(_can_reach(F.col("na"), F.col("n"), F.col("place_a"), F.col("place"), percent)).select("a", F.col("doc_id").alias("b")).distinct()
    links = materialise(_similar(led, sets, percent), "jaccard-links")
    named = components(links)
    apart = _apart(lists, named, percent)
    more = materialise(_between(apart, named, sets, percent), "jaccard-more-links")
    named = components(links.union(more))
    return classes.join(named, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _on_set(d: str, c: str) -> Column:
    return (F.col(f"{d}.n") == F.col(f"{c}.n")) & (F.col(f"{d}.print_a") == F.col(f"{c}.print_a")) & (F.col(f"{d}.print_b") == F.col(f"{c}.print_b"))


def groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    table = prepared(docs, words, percent)
    classes = materialise(_classes(table, percent), "jaccard-components")
    # most sets are components of their own; a large component is one key of few, so a skewed join splits it
    smallest = classes.groupBy("component").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("members")).where("members > 1").drop("members")
    found = classes.join(smallest, "component", "left").select("n", "print_a", "print_b", F.coalesce("component_id", "first").alias("component_id"))
    joined = table.select("doc_id", "n", "print_a", "print_b").alias("d").join(found.alias("c"), _on_set("d", "c"), "left")
    return joined.select(
        "d.doc_id", F.col("d.n").alias("n_shingles"), F.when(F.col("d.doc_id").isNotNull(), F.coalesce("c.component_id", "d.doc_id")).alias("component_id")
    )


def representatives(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents, with their columns, one of each component: a row with its smallest identifier.

    Rows without identifier or without words stay.
    """
    table = prepared(docs.select("doc_id", "text"), words, percent)
    classes = _classes(table, percent)
    # the set that answers for a component, then a row that answers for the set
    chosen = classes.groupBy("component").agg(F.min(F.struct("first", "n", "print_a", "print_b")).alias("s")).select("s.*")
    joined = table.select("doc_id", "mark", "n", "print_a", "print_b").alias("d").join(chosen.alias("c"), _on_set("d", "c") & (F.col("d.doc_id") == F.col("c.first")))
    rows = joined.groupBy("d.doc_id", "d.n", "d.print_a", "d.print_b").agg(F.min("d.mark").alias("mark")).select("doc_id", "mark")
    rows = materialise(rows, "jaccard-kept").withColumnsRenamed({"doc_id": "kept_id", "mark": "kept_mark"})
    apart = F.col("doc_id").isNull() | ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    # rows that repeat identifier and text are one
    mark = docs.where(~apart).select(F.struct(docs.columns).alias("row"), F.col("doc_id").alias("key_id"), text_mark().alias("key_mark"))
    kept = mark.join(rows, (F.col("key_id") == F.col("kept_id")) & (F.col("key_mark") == F.col("kept_mark")), "left_semi")
    return kept.dropDuplicates(["key_id", "key_mark"]).select("row.*").union(docs.where(apart))
