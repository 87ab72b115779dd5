"""Helpers that several operators of this folder share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows and bytes handed to Python at once: a batch ends at either, or with one row that is longer. All operators set the same, so that
#: the order of their calls does not matter to frames that are read later.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def release_memory() -> None:
    """Hand freed memory back to the system. Python workers outlive their tasks, and Spark's next step may need the memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library; it has ways of its own
        pass


def trimmed(fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``fn``, with memory released at the end of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        release_memory()

    return run


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with small batches, so that memory follows the longest texts, not the partition."""
    bound_batches(df.sparkSession)
    return df.mapInArrow(trimmed(fn), schema)


def per_row(make: Callable[[], Callable[[str], tuple]], fields: list[tuple[str, pa.DataType]], keep: list[str]) -> Callable:
    """A ``mapInArrow`` function that keeps the columns ``keep`` and adds ``fields``, computed from ``text``.

    ``make`` runs once per task and gives the function of one text, so a task may hold its own caches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        names = [*keep, *(n for n, _ in fields)]
        for batch in batches:
            results = [one(t) for t in batch.column("text").to_pylist()]
            columns = list(zip(*results, strict=True)) if results else [[] for _ in fields]
            arrays = [batch.column(k) for k in keep]
            arrays += [pa.array(values, kind) for values, (_, kind) in zip(columns, fields, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run
