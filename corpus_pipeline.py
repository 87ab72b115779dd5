"""A training corpus from raw documents: five stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stage before it kept; its decisions take effect.
The first three return the columns of ``documents``, mixing adds ``n_copies``: how often the mixed corpus has the document. The last
returns doc_id, n_copies, token_ids, n_tokens (of one copy) and the decoded text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import bpe, jaccard, lines, mixing, toxicity
from cohortlens.llm.queries import tokenizer_file
from cohortlens.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: shingles and similarity of the near-duplicate stage
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal regression finds toxic go."""
    return toxicity.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents that consist of them; ``n_chars`` follows the text."""
    left = lines.deduped(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard.representatives(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents get as many copies as the weights of their source, language and topic ask for; those without any go."""
    return mixing.counted(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the text decoded from them."""
    return bpe.tokenise(docs, tokenizer_file(), keep=["n_copies"])


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_copies", drop_near_copies),
    ("mixing", mix_sources),
    ("tokens", encode_tokens),
]

#: no SQL says the regression or the joins; tests/llm holds each stage against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
