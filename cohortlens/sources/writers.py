"""Sinks: text landing, append logs, partition overwrite, CSV and JSON outputs, catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortlens.schemas import NAMESPACES, OUTPUT_TABLES
from cohortlens.sources.records import QUOTING, CsvLoad

# cells are written as they are: quotes doubled, white space kept
CSV_OUT = {"header": True, **QUOTING, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def land_raw(tables: dict[str, DataFrame], namespace: str = "raw", location: str | None = None) -> dict[str, str]:
    """Replace one all-text table per source; returns the table names.

    With ``location`` the tables are external, one folder each below it.
    """
    names = {}
    for table, df in tables.items():
        name = f"`{namespace}`.`{table}`"
        writer = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]).write.mode("overwrite")
        if location:
            writer = writer.option("path", f"{location.rstrip('/')}/{table}")
        writer.saveAsTable(name)
        names[table] = name
    return names


def land_records(loads: dict[str, CsvLoad], namespace: str = "raw", location: str | None = None) -> DataFrame:
    """Land raw tables as text and say what was landed: table, rows, rejects.

    The counts are observed while the rows are written, so no file is read again for them. Rejects, if there
    are any, go to a table of their own, ``<table>_rejects``, with file, reason and record.
    """
    audit = []
    for table, load in loads.items():
        seen = Observation(f"landing {table}")
        parsed = load.parsed.observe(seen, *load.counts())
        good = parsed.where("reason is null").select(*[F.col("cells").getField(f"c{k}").alias(c) for k, c in enumerate(load.columns)])
        land_raw({table: good}, namespace, location)
        counts = seen.get
        if counts["rejects"]:
            land_raw({f"{table}_rejects": load.rejects}, namespace, location)
        audit.append((table, counts["rows"], counts["rejects"]))
    spark = next(iter(loads.values())).parsed.sparkSession
    return spark.createDataFrame(audit, "table string, rows long, rejects long")


def create_tables(spark: SparkSession, prefix: str = "") -> None:
    """Namespaces and output tables, left alone where they exist. ``prefix`` goes before the namespaces' names."""
    for namespace in NAMESPACES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{namespace}`")
    for (namespace, table), ddl in OUTPUT_TABLES.items():
        by = " PARTITIONED BY (run_date)" if ddl.startswith("run_date DATE") else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{prefix}{namespace}`.`{table}` ({ddl}) USING parquet{by}")


def table_columns(spark: SparkSession, prefix: str = "") -> DataFrame:
    """What the catalog says of the output tables, and what they hold: table, column, type, filled (values that are not null)."""
    out = None
    for namespace, table in OUTPUT_TABLES:
        name = f"{namespace}.{table}"
        rows = spark.table(f"`{prefix}{namespace}`.`{table}`")
        counts = rows.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c, _ in rows.dtypes])
        entries = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"`{c}`").alias("filled")) for c, t in rows.dtypes]))
        one = counts.select(entries.alias("e")).select(F.lit(name).alias("table"), "e.*")
        out = one if out is None else out.unionByName(one)
    return out


def add_missing_column(spark: SparkSession, table: str, column: str, sql_type: str) -> bool:
    """Add a column to a table that lacks it; says whether it did."""
    if column in spark.table(table).columns:
        return False
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({column} {sql_type})")
    return True


def append_rows(df: DataFrame, path: str) -> None:
    """Append to a table folder. No rows, no effect; a rerun appends again."""
    df.write.mode("append").parquet(path)


def append_table(df: DataFrame, table: str) -> None:
    """Append to a catalog table, columns matched by name and cast to the table's types."""
    target = df.sparkSession.table(table).schema
    df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target]).write.mode(
        "append"
    ).insertInto(table)


def replace_partitions(df: DataFrame, path: str, partition: str = "run_date") -> None:
    """Rerun-safe write: only the partitions present in ``df`` are replaced."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Append to a database table, one connection per partition."""
    df.write.jdbc(url, table, mode="append", properties=properties or {})


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, **CSV_OUT)


def write_small_csv(df: DataFrame, path: str) -> None:
    """One file; only for results of a fixed small size (a report, a grid, a 500-row sample)."""
    df.coalesce(1).write.mode("overwrite").csv(path, **CSV_OUT)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON document per row; only for results of a fixed small size."""
    df.coalesce(1).write.mode("overwrite").json(path)


def artifact_manifest(
    spark: SparkSession, folders: str | list[str], run_id: str, pattern: str = "*"
) -> DataFrame:
    """Path and size of each file below the output folders; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(folders)
        .select(
            F.lit(run_id).alias("run_id"),
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.col("length").alias("size_bytes"),
            F.col("path").alias("storage_uri"),
        )
    )


def manifest_document(
    manifest: DataFrame, run_id: str, created_at: str, model_name: str, sink: str
) -> DataFrame:
    """The manifest as one nested document per run; meant for the short report folders."""
    return manifest.groupBy("run_id").agg(
        F.lit(created_at).cast("timestamp").alias("created_at"),
        F.lit(model_name).alias("model_backend"),
        F.lit(sink).alias("sink"),
        F.sort_array(F.collect_list(F.struct("storage_uri", "file_name", "size_bytes"))).alias("artifacts"),
    ).filter(F.col("run_id") == F.lit(run_id))
