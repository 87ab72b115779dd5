"""The registered queries run; every stage of the pipeline against a plain version on its own input."""

from __future__ import annotations

import brute
import corpus_pipeline
import duckdb
from conftest import DATA

import __spark_entry__
from cohortlens.llm import mixing, toxicity
from cohortlens.llm.queries import ORACLES, tokenizer_file


def test_all_are_registered():
    names = [n for n in __spark_entry__.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_copies", "mixing", "tokens"]


def test_queries_with_sql(spark):
    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    for name, sql in ORACLES.items():
        got = __spark_entry__.queries()[name](spark, str(DATA))
        columns = sorted(got.columns)
        want = duck.sql(sql).select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
        assert brute.ordered([tuple(r[c] for c in columns) for r in got.collect()]) == brute.ordered(want), name


def test_stages(spark):
    sf = str(DATA)
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(120).cache()
    stage = dict(corpus_pipeline.STAGES)

    def table(df):
        return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]

    clean = stage["toxicity"](spark, docs, sf).cache()
    found = {r.doc_id for r in toxicity.severity(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("not toxic").collect()}
    assert {i for i, _ in table(clean)} == found and clean.columns == docs.columns
    # sentences of insults go, whatever else the model keeps
    left = stage["line_dedup"](spark, clean, sf).cache()
    want = {i: h for i, *_, h in brute.line_dedup(table(clean))}
    assert all(brute.sha(t or "") == want[i] for i, t in table(left)) and left.columns == docs.columns
    assert all(r.n_chars == len(r.text) for r in left.collect())
    apart = stage["near_copies"](spark, left, sf).cache()
    assert {i for i, _ in table(apart)} == {i for i, _, c in brute.jaccard(table(left), 5, 80) if i == c}
    mixed = stage["mixing"](spark, apart, sf).cache()
    assert {i for i, _ in table(mixed)} == {r.doc_id for r in mixing.mix(apart).where("sampled").collect()}
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file())
    texts = dict(table(mixed))
    tokens = stage["tokens"](spark, mixed, sf).collect()
    assert len(tokens) == len(texts)
    assert all(r.token_ids == library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids for r in tokens)
