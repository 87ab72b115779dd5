"""Tables stored for the reads that follow: co-located marts, and files of several generations under one schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import marts
from cohortlens.schemas import struct

#: the key that score history and panel are joined and windowed by, but for the week
STUDENT_MODULE = ("id_student", "code_module")


def store_bucketed(df: DataFrame, table: str, keys: Sequence[str] = STUDENT_MODULE, buckets: int | None = None, path: str | None = None, sort: Sequence[str] = ()) -> DataFrame:
    """Replace a catalog table whose files are dealt by ``keys``: one file per bucket, sorted by the keys and ``sort``.

    Joins, windows and groups over these keys (or these and more) then need no shuffle, as often as they are run. Tables
    that meet must have the same number of buckets; by default that is the session's number of shuffle partitions.
    """
    keys = list(keys)
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(n, *keys).write.mode("overwrite").bucketBy(n, *keys).sortBy(*keys, *sort)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def risk_weekly_stored(spark: SparkSession, scores: str, panel: str, info: str) -> DataFrame:
    """The joined mart over three tables stored by student and module: both joins run bucket by bucket."""
    return marts.risk_weekly(spark.table(scores), spark.table(panel), spark.table(info))


# The types that a stored type may be read as without losing a value.
WIDER = {
    "tinyint": {"smallint", "int", "bigint", "double"},
    "smallint": {"int", "bigint", "double"},
    "int": {"bigint", "double"},
    "float": {"double"},
    "date": {"timestamp_ntz"},
}


def read_generations(spark: SparkSession, folders: Sequence[str], schema: str) -> DataFrame:
    """Parquet folders written at different times, read as one declared schema.

    A column that a generation did not have is null, one whose type has been widened since is read as the wider type. A type that the declared one cannot
    hold, and a column that is not declared, is an error before any row is read: nothing is narrowed or dropped. The files
    of a folder have one schema, which Spark takes from a footer; each folder is a scan of its own, so columns and filters are pushed into it.
    """
    declared = struct(schema)
    out = None
    for folder in folders:
        rows = spark.read.parquet(folder)
        kinds = dict(rows.dtypes)
        if unknown := sorted(set(kinds) - set(declared.names)):
            raise ValueError(f"{folder} has columns that are not declared: {', '.join(unknown)}")
        for f in declared:
            have, want = kinds.get(f.name), f.dataType.simpleString()
            if have is not None and have != want and want not in WIDER.get(have, set()):
                raise ValueError(f"{folder}: {f.name} is {have}, which {want} cannot hold")
        columns = [F.col(f"`{f.name}`") if f.name in kinds else F.lit(None) for f in declared]
        part = rows.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, declared, strict=True)])
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], declared) if out is None else out
