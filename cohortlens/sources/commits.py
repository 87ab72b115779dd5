"""Runs that become visible as a whole: a commit log beside the tables.

A run writes each of its tables to a new folder and then, last, one line to the log: run, date, and per table the folder and
its rows. Readers see what the log names and nothing else. So a run that dies between two writes leaves the one before
readable, a rerun under the same name takes the place of the first, and the newest date is
known from the log without reading a table: the scan that follows opens the folder of that run only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LOG = "run_id string, run_date date, committed_at timestamp, sequence long, tables map<string, struct<path: string, rows: long>>"


class Run:
    """One run below ``root``. Nothing of it is seen before ``commit``. One run at a time writes below a root."""

    def __init__(self, spark: SparkSession, root: str, run_id: str, run_date: str):
        self.spark, self.root, self.run_id, self.run_date = spark, root.rstrip("/"), run_id, run_date
        self.tables: dict[str, tuple[str, int]] = {}
        # the log exists from the first run on; one that is there is left alone
        spark.createDataFrame([], LOG).coalesce(1).write.mode("ignore").json(f"{self.root}/_commits")

    def write(self, name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        """Write a table of the run and read it back. Its rows are counted on the way."""
        path = f"{name}/{self.run_id}-{uuid.uuid4().hex}"
        seen = Observation(f"{self.run_id} {name}")
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        writer = counted.write.partitionBy(partition_by) if partition_by else counted.write
        writer.parquet(f"{self.root}/{path}")
        self.tables[name] = (path, seen.get["rows"])
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{path}")

    def commit(self) -> None:
        """One line, one file: it is there or it is not."""
        known = log(self.spark, self.root)
        sequence = (known.agg(F.max("sequence")).first()[0] or 0) + 1
        row = (self.run_id, self.run_date, sequence, {k: {"path": p, "rows": n} for k, (p, n) in self.tables.items()})
        line = self.spark.createDataFrame([row], "run_id string, run_date string, sequence long, tables map<string, struct<path: string, rows: long>>")
        line = line.select("run_id", F.col("run_date").cast("date").alias("run_date"), F.current_timestamp().alias("committed_at"), "sequence", "tables")
        line.coalesce(1).write.mode("append").json(f"{self.root}/_commits")


def log(spark: SparkSession, root: str) -> DataFrame:
    """All commits, replaced ones too."""
    try:
        return spark.read.schema(LOG).json(f"{root.rstrip('/')}/_commits")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LOG)
        raise


def committed(spark: SparkSession, root: str) -> DataFrame:
    """One row per run and table: run_id, run_date, sequence, table, path, rows. Of a run's commits the last counts.

    As long as the list of runs: a row per run and table, whatever the tables hold.
    """
    last = F.row_number().over(W.partitionBy("run_id").orderBy(F.col("sequence").desc(), F.col("committed_at").desc()))
    runs = log(spark, root).withColumn("place", last).where("place = 1")
    return runs.select("run_id", "run_date", "sequence", F.explode("tables").alias("table", "at")).select("run_id", "run_date", "sequence", "table", "at.path", "at.rows")


def read_runs(spark: SparkSession, root: str, table: str, schema: str, runs: Iterable[str] | None = None) -> DataFrame:
    """The rows of a table of all committed runs, or of those named, with their run_id."""
    found = committed(spark, root).where(F.col("table") == table)
    if runs is not None:
        found = found.where(F.col("run_id").isin(list(runs)))
    out = None
    by_path = {r.path: r.run_id for r in found.orderBy("sequence").collect()}
    if by_path:
        rows = spark.read.schema(schema).parquet(*[f"{root.rstrip('/')}/{p}" for p in by_path])
        # the folder that a file lies in names the run
        folder = F.regexp_extract(F.col("_metadata.file_path"), f"/{table}/(.*)-[0-9a-f]{{32}}/", 1)
        out = rows.withColumn("run_id", F.url_decode(folder))
    return spark.createDataFrame([], f"{schema}, run_id string") if out is None else out


def newest_run(spark: SparkSession, root: str, table: str, schema: str, run_date: str | None = None) -> DataFrame:
    """The rows of the newest run (of one date, if given); only its folder is read."""
    found = committed(spark, root).where(F.col("table") == table)
    if run_date is not None:
        found = found.where(F.col("run_date") == F.lit(run_date).cast("date"))
    last = found.orderBy(F.col("run_date").desc(), F.col("sequence").desc()).first()
    if last is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{last.path}")
