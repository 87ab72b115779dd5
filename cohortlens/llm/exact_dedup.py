"""Exact dedup as a stateful stream: keyed state on disk, no expiry, full bytes checked on hits.

``dedup`` streams the files of a Parquet table through a stateful aggregation keyed by the SHA-256 of the
normalised text. The state (RocksDB, on the executors' disks, with changelogs in the shared checkpoint
folder) keeps for every text ever seen its digest, the smallest identifier, the locator of that row's content
(file and row in the file) and the number of rows. It never expires, and a later run with the same
``checkpoint`` reads new files only, of the same table or of another one: ``keep_id`` and ``group_size`` then
cover all tables read so far, and texts kept from another table are fetched through their locators. Each task merges its rows by digest before the shuffle, so a group
that holds a third of all rows reaches its state as one row per task. Then every row
whose digest has more than one row is compared with the kept row's text, byte by byte; rows that only share the
digest form groups of their own.

Only DataFrame and SQL functions are used.

Defined cases: a null text counts as empty; texts are equal when they are identical after each run of
``[\\x20\\x09-\\x0D]`` is replaced by one space; a null identifier is larger than any other and stays only
if its group has no other; rows that repeat an identifier count each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import materialise, scratch_path

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space. Single spaces stay as they are and need no match."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def pattern_of(path: str) -> str:
    """A pattern that only ``path`` matches: a stream takes a plain path to be a folder, a pattern may be one file."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def digest(normal: Column) -> Column:
    return F.sha2(normal.cast("binary"), 256)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _rows(table: DataFrame, id_col: str, text_col: str) -> DataFrame:
    # the files' own metadata, also where the table has a column of that name
    meta = table.metadataColumn("_metadata")
    rows = table.select(
        F.col(id_col).cast("long").alias("doc_id"),
        normalised(F.col(text_col)).alias("normal"),
        meta.getField("file_path").alias("file"),
        meta.getField("row_index").alias("row"),
    )
    return rows.withColumn("digest", digest(F.col("normal")))


def keyed_state(spark: SparkSession, path: str, checkpoint: str | None = None, id_col: str = "doc_id", text_col: str = "text", max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream all files of ``path`` that the checkpoint has not seen; then the state: one row per digest.

    Columns: digest, keep_id, file, row (the locator), group_size.
    """
    checkpoint = checkpoint or scratch_path(spark, "exact-dedup-state")
    source = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        source = source.option("maxFilesPerTrigger", max_files_per_trigger)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row"))
    groups = _rows(source.parquet(pattern_of(path)), id_col, text_col).groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("n"))
    settings = {
        PROVIDER: ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # many small stores: no space is reserved ahead of use
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
        "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    }
    with _settings(spark, settings):
        query = groups.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        if query.lastProgress is None and not query.recentProgress:  # no file at all: there is no state yet
            return groups_of_nothing(spark)
        state = spark.read.format("statestore").load(checkpoint)
        kept, n = (f"value.`{c}`" for c in state.schema["value"].dataType.names)
        state = state.select(
            F.col("key.digest").alias("digest"),
            F.col(kept + ".doc_id").alias("keep_id"),
            F.col(kept + ".file").alias("file"),
            F.col(kept + ".row").alias("row"),
            F.col(n).alias("group_size"),
        )
        return materialise(state, "exact-dedup-groups")


def groups_of_nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "digest string, keep_id long, file string, row long, group_size long")


def dedup(spark: SparkSession, path: str, checkpoint: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of the table: doc_id, keep_id, group_size, kept, text_sha256."""
    state = keyed_state(spark, path, checkpoint, id_col, text_col)
    rows = _rows(spark.read.parquet(path), id_col, text_col)
    alone = rows.select("doc_id", "digest").join(state.where("group_size = 1").select("digest"), "digest").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "digest"
    )
    shared = state.where("group_size > 1").select("digest", "keep_id", "group_size", F.col("file").alias("kept_file"), F.col("row").alias("kept_row"))
    hits = materialise(rows.join(shared, "digest"), "exact-dedup-hits")
    kept = hits.where((F.col("file") == F.col("kept_file")) & (F.col("row") == F.col("kept_row"))).select("digest", F.col("normal").alias("kept_normal"))
    kept = kept.unionByName(_kept_elsewhere(spark, hits, kept, id_col, text_col))
    # null: the bytes are those of the kept row; otherwise a text that only shares the digest
    other = F.when(F.col("normal") != F.col("kept_normal"), F.col("normal"))
    checked = materialise(hits.join(kept, "digest", "left").select("doc_id", "digest", "keep_id", "group_size", other.alias("other")), "exact-dedup-checked")
    strangers = checked.where("other is not null")
    groups = strangers.groupBy("digest", "other").agg(F.min("doc_id").alias("own_keep"), F.count(F.lit(1)).alias("own_size"))
    apart = strangers.join(groups, ["digest", "other"]).select("doc_id", F.col("own_keep").alias("keep_id"), F.col("own_size").alias("group_size"), "digest")
    less = strangers.groupBy("digest").agg(F.count(F.lit(1)).alias("less"))
    together = checked.where("other is null").join(less, "digest", "left").select(
        "doc_id", "keep_id", (F.col("group_size") - F.coalesce("less", F.lit(0))).alias("group_size"), "digest"
    )
    return alone.unionByName(together).unionByName(apart).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256")
    )


def _kept_elsewhere(spark: SparkSession, hits: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Kept texts that lie in tables streamed earlier with the same checkpoint, read from the files that the state names.

    Only names of files come to the driver, as with any listing of input.
    """
    missing = hits.join(kept, "digest", "left_anti").select("digest", "kept_file", "kept_row").distinct()
    files = [r.kept_file for r in missing.select("kept_file").distinct().collect()]
    if not files:
        return kept.limit(0)
    found = _rows(spark.read.parquet(*files), id_col, text_col).drop("doc_id", "digest")
    at = (F.col("file") == F.col("kept_file")) & (F.col("row") == F.col("kept_row"))
    return found.join(missing, at).select("digest", F.col("normal").alias("kept_normal"))
