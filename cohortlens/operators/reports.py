"""Report queries: rankings, trends, verification, column statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.functions.ordered import exact_quantiles
from cohortlens.operators.scoring import risk_order


def latest_run(mart: DataFrame) -> DataFrame:
    """Rows of the newest run; on a mart partitioned by run_date the filter prunes partitions."""
    newest = mart.agg(F.max("run_date").alias("run_date")).scalar()
    return mart.filter(F.col("run_date") == newest)


def run_day_top(mart: DataFrame, run_date: str | None = None, n: int = 100) -> DataFrame:
    """The n highest risks of one run date (today by default)."""
    day = F.current_date() if run_date is None else F.lit(run_date).cast("date")
    return mart.filter(F.col("run_date") == day).orderBy(*risk_order()).limit(n)


def course_ranking(summary: DataFrame) -> DataFrame:
    """Course summary, newest run first, then by high-risk share."""
    return summary.select("run_date", "code_module", "student_count", "avg_risk_score", "high_risk_rate").orderBy(
        F.col("run_date").desc(), F.col("high_risk_rate").desc(), "code_module"
    )


def weekly_course_order(summary: DataFrame) -> DataFrame:
    return summary.orderBy("week", F.col("high_risk_rate").desc(), "code_module")


def top_courses(summary: DataFrame, n: int = 3) -> DataFrame:
    """Per week the courses with the highest high-risk share; a week has one row per course."""
    order = W.partitionBy("run_date", "week").orderBy(F.col("high_risk_rate").desc(), F.col("code_module"))
    return summary.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)


def module_heatmap(summary: DataFrame, modules: Sequence[str] | None = None) -> DataFrame:
    """High-risk share by week (rows) and module (columns): all modules there are, or those asked for."""
    return summary.groupBy("week").pivot("code_module", list(modules) if modules is not None else None).agg(F.avg("high_risk_rate"))


def module_rates(summary: DataFrame) -> DataFrame:
    """The cells of the heatmap as rows: week, module, high-risk share. No list of modules is needed."""
    return summary.groupBy("week", "code_module").agg(F.avg("high_risk_rate").alias("high_risk_rate"))


def risk_trend(mart: DataFrame) -> DataFrame:
    return mart.groupBy("run_date", "week").agg(F.avg("risk_score").alias("avg_risk_score"))


def risk_histogram(mart: DataFrame, bins: int = 20) -> DataFrame:
    """Rows per score bin of equal width in [0, 1]; score 1 belongs to the last bin."""
    score = F.col("risk_score")
    known = mart.filter(score.isNotNull())
    bin_number = F.least(F.floor(score * F.lit(bins)) + 1, F.lit(bins)).cast("int")
    return known.groupBy(bin_number.alias("bin")).agg(F.count("*").alias("rows"))


def mart_verification(mart: DataFrame) -> DataFrame:
    """Week range, number of weeks, rows and scored rows, one row.

    Counting rows per week first leaves one row per week for the distinct count.
    """
    weeks = mart.groupBy("week").agg(F.count("*").alias("n"), F.count("risk_score").alias("scored"))
    return weeks.agg(
        F.min("week").alias("min_week"),
        F.max("week").alias("max_week"),
        F.count("week").alias("weeks"),
        F.sum("n").alias("rows"),
        F.sum("scored").alias("scored_rows"),
    )


def rows_per_week(mart: DataFrame, n: int = 20) -> DataFrame:
    return mart.groupBy("week").agg(F.count("*").alias("rows")).orderBy("week").limit(n)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows and share per value; the total is one number."""
    counts = df.groupBy(column).agg(F.count("*").alias("rows"))
    return counts.withColumn("share", F.col("rows") / df.agg(F.count("*").alias("n")).scalar())


def unpivot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("pair")).select("pair.*")


def column_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column.

    The quartiles are exact at any size: see ``functions.ordered``.
    """
    long = unpivot(df, columns)
    moments = long.groupBy("feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(long, "value", (0.25, 0.5, 0.75), ["feature"]).toDF("feature", "p25", "p50", "p75")
    return moments.join(quartiles, "feature", "left").select("feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, all in one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]

    def measure(a: str, b: str) -> Column:
        # a column that varies correlates with itself, any other with nothing
        return F.corr(a, b) if a != b else F.when(F.min(a) < F.max(a), F.lit(1.0))

    row = df.agg(*[measure(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        for x, y in dict.fromkeys([(a, b), (b, a)]):
            entries.append(F.struct(F.lit(x).alias("feature_x"), F.lit(y).alias("feature_y"), F.col(f"c{i}").alias("correlation")))
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def experiment_listing(results: DataFrame) -> DataFrame:
    return results.orderBy(F.col("run_ts").desc(), "uplift_scenario")


def alert_timeline(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy(F.col("run_ts").desc())


def preview(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*keys).limit(n)
