"""Train and test rows: by time, by class, and seeded samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.functions.columns import uniform
from cohortlens.params import RunParams
from cohortlens.schemas import MODEL_FEATURES, MODEL_LABEL


def model_rows(panel: DataFrame) -> DataFrame:
    """Rows with every feature and the label present."""
    return panel.dropna(subset=[*MODEL_FEATURES, MODEL_LABEL])


def week_range(df: DataFrame, share: float = 0.7) -> DataFrame:
    """First and last week and the linear quantile of the week, one row.

    The quantile runs over rows per week, a frame as short as the calendar.
    """
    weeks = df.groupBy("week").agg(F.count("*").alias("n"))
    return weeks.agg(
        F.min("week").alias("min_week"),
        F.max("week").alias("max_week"),
        F.expr(f"percentile(week, {share}, n)").alias("week_quantile"),
    )


def split_week(df: DataFrame, wanted: int = RunParams.split_week) -> DataFrame:
    """The week that parts train from test, one row.

    The wanted week, lowered to the last week; if no row lies before it, the 0.7 quantile.
    """
    at = F.least(F.lit(wanted), F.col("max_week"))
    return week_range(df).select(
        F.when(F.col("min_week") >= at, F.col("week_quantile").cast("int")).otherwise(at).alias("split_week")
    )


def time_split(df: DataFrame, wanted: int = RunParams.split_week) -> DataFrame:
    """Add ``side``: train before the split week, test from it on."""
    at = split_week(df, wanted).scalar()
    return df.withColumn("side", F.when(F.col("week") < at, F.lit("train")).otherwise(F.lit("test")))


def stratified_split(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    test_share: float = 0.2,
    seed: int = RunParams.seed,
    buckets: int = 4096,
) -> DataFrame:
    """Add ``side`` with an exact test share per class, by a seeded order of the unique keys.

    Test rows are the first of each class in the order of a hash. Counting rows per class and
    hash bucket finds the one bucket per class where the cut falls; only that bucket's rows
    are ranked, all others are decided by their bucket number alone.
    """
    placed = df.withColumn("_u", uniform(seed, *[F.col(k) for k in keys])).withColumn(
        "_bucket", F.floor(F.col("_u") * F.lit(buckets)).cast("int")
    )
    sizes = placed.groupBy(label, "_bucket").agg(F.count("*").alias("_n"))
    by_class = W.partitionBy(label)
    everything = W.partitionBy()
    reach = sizes.select(
        label,
        "_bucket",
        "_n",
        F.sum("_n").over(by_class.orderBy("_bucket")).alias("_reach"),
        F.sum("_n").over(by_class).alias("_class"),
        F.sum("_n").over(everything).alias("_all"),
    )
    # rows for training per class: the floor of the exact share, the rest by largest remainder
    train_rows = F.col("_all") - F.ceil(F.col("_all") * F.lit(test_share))
    exact = train_rows * F.col("_class") / F.col("_all")
    classes = reach.select(label, "_class", train_rows.alias("_train"), exact.alias("_exact")).distinct()
    order = W.orderBy((F.col("_exact") - F.floor("_exact")).desc(), F.col(label))
    quota = classes.select(
        label,
        (
            F.col("_class")
            - F.floor("_exact")
            - F.when(F.row_number().over(order) <= F.col("_train") - F.sum(F.floor("_exact")).over(everything), 1).otherwise(0)
        ).alias("_test"),
    )
    # per class: the bucket in which the quota is met, and how many of its rows are taken
    cut = (
        reach.join(quota, label)
        .filter((F.col("_reach") >= F.col("_test")) & (F.col("_reach") - F.col("_n") < F.col("_test")))
        .select(label, F.col("_bucket").alias("_cut"), (F.col("_test") - F.col("_reach") + F.col("_n")).alias("_take"))
    )
    # one row per class; Spark broadcasts it by its measured size
    joined = placed.join(cut, label, "left")
    below = F.when(F.col("_bucket") < F.col("_cut"), F.lit("test")).otherwise(F.lit("train"))
    decided = joined.filter(F.col("_cut").isNull() | (F.col("_bucket") != F.col("_cut"))).withColumn("side", below)
    ranked = W.partitionBy(label).orderBy("_u", *keys)
    open_rows = joined.filter(F.col("_bucket") == F.col("_cut")).withColumn(
        "side", F.when(F.row_number().over(ranked) <= F.col("_take"), F.lit("test")).otherwise(F.lit("train"))
    )
    columns = [*df.columns, "side"]
    return decided.select(*columns).unionByName(open_rows.select(*columns))


def seeded_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int = RunParams.seed) -> DataFrame:
    """``n`` rows (or all, if fewer) in a seeded order of the keys; equal on every rerun."""
    order = uniform(seed, *[F.col(k) for k in keys])
    return df.withColumn("_u", order).orderBy("_u", *keys).limit(n).drop("_u")
