"""Toxicity as ordinal severity: a cumulative-link regression on sparse text features.

A document's features are its words and its words' prefixes (invented and inflected insults share stems),
each as "occurs" and as "occurs often": at least twice and in at least one of ``OFTEN`` words. ``fit`` takes labelled
documents, counts for every feature in how many toxic and clean ones it occurs (all of them within the documented bound), keeps
the ``FEATURES`` features with the largest log-odds z-scores, grades the toxic documents 1 to ``GRADES`` - 1
by terciles of how many toxic features they hold (clean ones are grade 0), and fits

    P(grade > k | x) = logistic(w . x - cut_k),   cut_0 <= cut_1 <= ...

with one weight vector for all ordered thresholds, by gradient steps on the penalised likelihood. ``score`` gives
the expected severity, the sum of these probabilities, and P(grade > 0). ``reject`` drops documents above ``LIMIT``.

Bounds: the classifier is fitted on at most ``TRAIN_ROWS`` labelled documents, chosen by a hash of the identifier; this bounds
the matrix on the driver. Scoring reads every whole text.

Defined cases: a null or empty text has no features and gets the severity of the intercept alone; labels that are null or whose document is
missing are ignored; an identifier labelled twice is toxic if one label is; without both classes in the labels the
severity is 0 for all; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, release_memory, text_or_empty

TRAIN_ROWS, FEATURES, GRADES = 20_000, 4_000, 4
PREFIXES = (4, 5, 6, 7)
#: words, or features, that a task keeps in memory before it starts anew
KNOWN_WORDS = 60_000
OFTEN = 100
MIN_DOCS = 5
#: a document is rejected when P(grade > 0) reaches this; clean held-out documents stay below 0.25
LIMIT = 0.3

_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    return [word, *(word[:k] + "-" for k in PREFIXES if len(word) >= k)]


def features(text: str) -> set[str]:
    """Names of the features of one text; ``+`` marks those that occur often."""
    words = Counter(_WORD.findall(text.lower()))
    counts: Counter[str] = Counter()
    for word, n in words.items():
        for f in word_features(word):
            counts[f] += n
    least = max(2, sum(words.values()) / OFTEN)
    return set(counts) | {f + "+" for f, n in counts.items() if n >= least}


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    cuts: list[float] = field(default_factory=lambda: [np.inf] * (GRADES - 1))

    def scorer(self) -> Callable[[str], tuple[float, float]]:
        """Expected severity and P(grade > 0) of a text. Only words that touch a feature of the model are counted."""
        plain = {f: w for f, w in self.weights.items() if not f.endswith("+")}
        often = {f[:-1]: w for f, w in self.weights.items() if f.endswith("+")}
        known = plain.keys() | often.keys()
        touches: dict[str, tuple[str, ...]] = {}
        cuts = np.array(self.cuts)

        def of(word: str) -> tuple[str, ...]:
            found = tuple(f for f in word_features(word) if f in known)
            if len(touches) >= KNOWN_WORDS:
                touches.clear()
            touches[word] = found
            return found

        def one(text: str) -> tuple[float, float]:
            words = _WORD.findall(text.lower())
            counts: dict[str, int] = {}
            for word in words:
                found = touches.get(word)
                if found is None:
                    found = of(word)
                for f in found:
                    counts[f] = counts.get(f, 0) + 1
            least = max(2, len(words) / OFTEN)
            margin = sum([plain.get(f, 0.0) + (often.get(f, 0.0) if n >= least else 0.0) for f, n in counts.items()])
            above = np.isfinite(cuts) / (1 + np.exp(np.clip(cuts - margin, -700, 700)))
            return float(above.sum()), float(above[0])

        return one


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, n_features: int, steps: int = 400, penalty: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts by Adam steps on the mean log-likelihood. ``rows`` holds the feature numbers of each document."""
    lengths = np.array([len(r) for r in rows])
    owner = np.repeat(np.arange(len(rows)), lengths)
    index = np.concatenate(rows) if len(owner) else np.zeros(0, dtype=np.int64)
    k = GRADES - 1
    share = np.array([(grades > j).mean() for j in range(k)]).clip(1e-4, 1 - 1e-4)
    start = np.log((1 - share) / share)
    # cuts are the first one and positive gaps, so their order holds
    theta = np.concatenate([np.zeros(n_features), start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    n = len(rows)
    for step in range(1, steps + 1):
        w, gaps = theta[:n_features], np.exp(theta[n_features + 1 :])
        cuts = theta[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])
        margin = np.bincount(owner, w[index], minlength=n)
        below = 1 / (1 + np.exp(np.clip(margin[:, None] - cuts[None, :], -35, 35)))  # P(grade <= j)
        edges = np.concatenate([np.zeros((n, 1)), below, np.ones((n, 1))], axis=1)
        rows_at = np.arange(n)
        high, low = edges[rows_at, grades + 1], edges[rows_at, grades]
        p = np.maximum(high - low, 1e-12)
        d_high = np.where(grades < k, high * (1 - high), 0.0) / p
        d_low = np.where(grades > 0, low * (1 - low), 0.0) / p
        by_margin = (d_high - d_low) / n  # of the loss
        grad = np.zeros_like(theta)
        grad[:n_features] = np.bincount(index, by_margin[owner], minlength=n_features) + penalty * w
        by_cut = np.zeros(k)
        np.add.at(by_cut, np.minimum(grades, k - 1), np.where(grades < k, -d_high, 0.0) / n)
        np.add.at(by_cut, np.maximum(grades - 1, 0), np.where(grades > 0, d_low, 0.0) / n)
        grad[n_features] = by_cut.sum()
        grad[n_features + 1 :] = np.cumsum(by_cut[::-1])[::-1][1:] * gaps
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    cuts = theta[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(theta[n_features + 1 :]))])
    return theta[:n_features], cuts


def z_scores(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    a, b, c, d = toxic + 0.5, clean + 0.5, n_toxic - toxic + 0.5, n_clean - clean + 0.5
    return (np.log(a / c) - np.log(b / d)) / np.sqrt(1 / a + 1 / b + 1 / c + 1 / d)


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """text and toxic (0 or 1) of at most about ``most`` labelled documents."""
    flags = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    count = flags.count()
    if count > most:
        flags = flags.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * most / count))
    # at most `most` rows of two numbers: small by the bound above
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).join(F.broadcast(flags), "doc_id").select("text", "toxic")


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a task: feature, toxic documents, clean documents. Empty feature: all documents."""
    counts: dict[str, list[int]] = {}

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array([c[1] for c in counts.values()], pa.int64()), pa.array([c[0] for c in counts.values()], pa.int64())],
            names=["feature", "toxic", "clean"],
        )

    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            for f in [*features(text), ""]:
                counts.setdefault(f, [0, 0])[toxic] += 1
        if len(counts) > KNOWN_WORDS:
            yield out()
            counts = {}
    yield out()


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, n_features: int = FEATURES) -> Model:
    rows = training_rows(docs, labels, train_rows)
    counts = map_arrow(rows, _count_features, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    totals = counts.where("feature = ''").first()
    if totals is None or not totals.toxic or not totals.clean:
        return Model()
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    c, d = totals.toxic - F.col("toxic") + 0.5, totals.clean - F.col("clean") + 0.5
    z = (F.log(a / c) - F.log(b / d)) / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    ranked = counts.where(f"feature <> '' and toxic + clean >= {MIN_DOCS}").withColumn("z", z)
    best = ranked.orderBy(F.abs("z").desc(), "feature").limit(n_features).select("feature", "z").collect()
    number = {r.feature: i for i, r in enumerate(best)}
    names = [r.feature for r in best]
    strong = np.array([r.z for r in best]) > 4.0

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(number[f] for f in features(t) if f in number) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "found"])

    # bounded by train_rows and n_features
    train = map_arrow(rows, numbered, "toxic int, found array<int>").toPandas()
    found = [np.asarray(x, dtype=np.int64) for x in train["found"]]
    toxic = train["toxic"].to_numpy()
    held = np.array([strong[x].sum() for x in found])
    grades = np.zeros(len(found), dtype=np.int64)
    levels = np.quantile(held[toxic == 1], [1 / 3, 2 / 3])
    grades[toxic == 1] = 1 + np.searchsorted(levels, held[toxic == 1], side="left")
    order = np.lexsort((held, grades, [len(x) for x in found]))  # sums do not depend on the order of tasks
    weights, cuts = fit_ordinal([found[i] for i in order], grades[order], len(names))
    del train, found
    release_memory()  # the driver goes on with the next stages
    return Model({n: float(w) for n, w in zip(names, weights, strict=True) if w != 0.0}, [float(x) for x in cuts])


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``row`` (the row of ``docs``, whatever its columns are called), ``severity`` and ``p_toxic``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    at = docs.columns.index(text_col)
    schema = rows.select("row", F.lit(0.0).alias("severity"), F.lit(0.0).alias("p_toxic")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = model.scorer()
        for batch in batches:
            results = [one(t or "") for t in batch.column("row").field(at).to_pylist()]
            added = [pa.array([r[i] for r in results], pa.float64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *added], names=["row", "severity", "p_toxic"])

    return map_arrow(rows, run, schema)


def severity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, severity (expected grade), p_toxic, toxic."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("row.doc_id", "severity", "p_toxic", (F.col("p_toxic") >= LIMIT).alias("toxic"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with the columns they came with."""
    kept = score(docs, fit(docs, labels)).where(F.col("p_toxic") < LIMIT)
    return kept.select([F.col("row").getField(c).alias(c) for c in docs.columns])
