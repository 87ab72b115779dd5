"""Global order statistics without a single-task window.

Running sums, ranks and exact quantiles over a whole table need a global order. A window
without partition would bring all rows into one task. Here the ordered column is cut into
buckets at approximate quantiles (a short list of numbers, the only thing the driver sees);
each bucket is summed within its own task and shifted by the totals of the buckets before
it, a frame of one row per bucket and group. Rows must be unique in the ordered column per
group, so callers aggregate first; then one hot value is one row and no bucket is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.functions.columns import uniform
from cohortlens.session import checkpointed

BUCKET = "_bucket"


def bucket_count(df: DataFrame) -> int:
    """Buckets follow the shuffle parallelism of the session, hence the cluster."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def with_buckets(df: DataFrame, order_by: str, buckets: int | None = None) -> DataFrame:
    """Add a bucket number by approximate quantiles of ``order_by``."""
    n = buckets or bucket_count(df)
    wanted = [i / n for i in range(1, n)]
    points = sorted(set(df.approxQuantile(order_by, wanted, 1.0 / (4 * n))))
    points = [p for p in points if p not in (float("inf"), float("-inf"))]
    if not points:
        return df.withColumn(BUCKET, F.lit(0))
    splits = [float("-inf"), *points, float("inf")]
    cut = Bucketizer(splits=splits, inputCol=order_by, outputCol=BUCKET).transform(df)
    return cut.withColumn(BUCKET, F.col(BUCKET).cast("int"))


def running_sums(
    df: DataFrame,
    order_by: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum) and ``total_<c>`` for each summed column.

    The input is read three times (limits, totals, rows), so it is checkpointed first.
    """
    by = list(by)
    cut = with_buckets(checkpointed(df), order_by, buckets)
    before = W.partitionBy(*by).orderBy(F.col(BUCKET).desc() if descending else F.col(BUCKET))
    whole = W.partitionBy(*by)
    offsets = (
        cut.groupBy(*by, BUCKET)
        .agg(*[F.sum(c).alias(c) for c in sums])
        .select(
            *by,
            BUCKET,
            *[F.coalesce(F.sum(c).over(before.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias(f"_before_{c}") for c in sums],
            *[F.sum(c).over(whole).alias(f"total_{c}") for c in sums],
        )
    )
    inside = W.partitionBy(*by, BUCKET).orderBy(
        F.col(order_by).desc() if descending else F.col(order_by)
    ).rowsBetween(W.unboundedPreceding, 0)
    joined = cut.join(offsets, [*by, BUCKET])
    return joined.select(
        *df.columns,
        *[(F.sum(c).over(inside) + F.col(f"_before_{c}")).alias(f"cum_{c}") for c in sums],
        *[F.col(f"total_{c}") for c in sums],
    )


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact, linearly interpolated quantiles of ``value`` per group as columns ``q0, q1, ...``."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    ranked = running_sums(counts, value, ["n"], by)
    first = F.col("cum_n") - F.col("n")

    def at(position: Column) -> Column:
        return F.max(F.when((first <= position) & (position < F.col("cum_n")), F.col(value)))

    aggregates = []
    for i, p in enumerate(probs):
        place = F.lit(p) * (F.col("total_n") - F.lit(1))
        low = F.floor(place)
        high = F.least(low + F.lit(1), F.col("total_n") - F.lit(1))
        aggregates += [
            at(low).alias(f"_low{i}"),
            at(high).alias(f"_high{i}"),
            F.max(place - low).alias(f"_part{i}"),
        ]
    grouped = ranked.groupBy(*by).agg(*aggregates)
    return grouped.select(
        *by,
        *[
            (F.col(f"_low{i}") + F.col(f"_part{i}") * (F.col(f"_high{i}") - F.col(f"_low{i}"))).alias(f"q{i}")
            for i in range(len(probs))
        ],
    )


def shuffled_ranks(df: DataFrame, keys: Sequence[str], seed: int, buckets: int | None = None) -> DataFrame:
    """Add ``_rank`` (0-based place in a seeded random order) and ``_rows`` (row count).

    ``keys`` must name a unique key. The order is that of a hash, so buckets of equal width
    are balanced and no quantiles are needed.
    """
    n = buckets or bucket_count(df)
    placed = df.withColumn("_u", uniform(seed, *[F.col(k) for k in keys])).withColumn(
        BUCKET, F.floor(F.col("_u") * F.lit(n)).cast("int")
    )
    sizes = placed.groupBy(BUCKET).agg(F.count("*").alias("_size"))
    before = W.orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        BUCKET,
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.sum("_size").over(W.partitionBy()).alias("_rows"),
    )
    inside = W.partitionBy(BUCKET).orderBy("_u", *keys)
    return (
        placed.join(offsets, BUCKET)
        .withColumn("_rank", F.col("_before") + F.row_number().over(inside) - F.lit(1))
        .drop("_u", BUCKET, "_before")
    )
