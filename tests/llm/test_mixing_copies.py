"""The sample itself, not only the cells' weights, meets the targets."""

from __future__ import annotations

import corpus_pipeline
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from cohortlens.llm import bpe, mixing
from cohortlens.llm.queries import QUERIES, tokenizer_file

SHARES = {"source": {"big": 0.5, "mid": 0.3, "rare": 0.2}, "lang": {"en": 0.6, "de": 0.4}, "topic": {"prose": 0.7, "legal": 0.3}}


@pytest.fixture(scope="module")
def skewed(spark):
    """6,000 documents of four tokens; a rare source of 3 %, a topic of 5 %."""
    rows = []
    for k in range(6000):
        source = "rare" if k % 100 < 3 else "mid" if k % 100 < 15 else "big"
        rows.append((k, "License a b c" if k % 20 == 7 or k % 300 == 1 else "a b c d", "de" if k % 7 == 0 else "en", source))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)


def shares(sample, margin: str, weight: str) -> dict:
    total = sample.agg(F.sum(weight)).first()[0]
    return {r[0]: r[1] / total for r in sample.groupBy(margin).agg(F.sum(weight)).collect()}


def test_sampled_token_shares_meet_the_targets(skewed):
    sample = mixing.sampled(skewed, targets=SHARES).select("*", *mixing.described(skewed)).cache()
    assert abs(sample.count() - 6000) < 300
    for margin, wanted in SHARES.items():
        got = shares(sample, f"_{margin}", "_tokens")
        assert all(abs(got[v] - s) < 0.02 for v, s in wanted.items()), (margin, got)


def test_copies_follow_the_factor(skewed):
    rows = mixing.copies(skewed, targets=SHARES).collect()
    assert len(rows) == 6000 and max(r.factor for r in rows) > 3
    assert all(int(r.factor) <= r.n_copies <= int(r.factor) + 1 for r in rows)
    again = mixing.copies(skewed.repartition(7), targets=SHARES).collect()
    assert {(r.doc_id, r.n_copies) for r in rows} == {(r.doc_id, r.n_copies) for r in again}
    # the registered query has the same copies
    mixed = {r.doc_id: (r.n_copies, r.sampled) for r in mixing.mix(skewed, targets=SHARES).collect()}
    assert all(mixed[r.doc_id] == (r.n_copies, r.n_copies > 0) for r in rows)
    counted = mixing.counted(skewed, targets=SHARES)
    assert counted.columns == [*skewed.columns, "n_copies"]
    assert {(r.doc_id, r.n_copies) for r in counted.collect()} == {(r.doc_id, r.n_copies) for r in rows if r.n_copies}


def test_the_registered_sample_meets_the_targets(spark):
    """Token shares of the whole table's sample against natural share ** 0.7, within what drawing the fractions allows."""
    rows = QUERIES["op9_source_mixing"](spark, str(DATA.parent / "sf0.1")).cache()
    sample = rows.withColumn("tokens", F.col("n_tokens") * F.col("n_copies"))
    for margin in mixing.MARGINS:
        natural, got = shares(rows, margin, "n_tokens"), shares(sample, margin, "tokens")
        norm = sum(s**0.7 for s in natural.values())
        assert all(abs(got[v] - s**0.7 / norm) < 0.005 for v, s in natural.items()), (margin, got)


def test_the_pipeline_carries_the_copies(spark, skewed):
    stage = dict(corpus_pipeline.STAGES)
    mixed = stage["mixing"](spark, skewed, str(DATA))
    tokens = stage["tokens"](spark, mixed, str(DATA)).collect()
    assert {(r.doc_id, r.n_copies) for r in tokens} == {(r.doc_id, r.n_copies) for r in mixing.counted(skewed).collect()}
    assert max(r.n_copies for r in tokens) > 1
    assert bpe.tokenise(skewed, tokenizer_file()).columns == ["doc_id", "token_ids", "n_tokens", "decoded"]
    assert QUERIES["source_mixing_copies"](spark, str(DATA)).where("n_copies > 1").count() > 0
