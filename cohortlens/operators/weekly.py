"""The weekly panel: one row per student, module and week.

Two ways lead to the same panel. ``weekly_panel`` takes clean events that already exist as a
table. ``weekly_panel_from_sources`` never builds the fanned-out event rows: it sums the
submissions per student and week (with map-side combine, so a student holding a third of all
rows shrinks to one row per week before the shuffle), folds the info rows per student and
module, and joins the two small sides. Each event appears once per info row of its module,
so sums are multiplied by the folded row count while means and maxima do not change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from cohortlens.functions.columns import clip_sql
from cohortlens.operators.events import dated_submissions
from cohortlens.schemas import ATTRIBUTES, check_dialect


def by_week() -> WindowSpec:
    """One spec for all panel columns: one shuffle, one sort. A key has one row per week."""
    return W.partitionBy("id_student", "code_module").orderBy("week")


def weekly_aggregate(events: DataFrame) -> DataFrame:
    """Default dialect: rows with a null key are dropped, attributes are maxima."""
    keyed = events.filter(F.col("id_student").isNotNull() & F.col("code_module").isNotNull() & F.col("week").isNotNull())
    return keyed.groupBy("id_student", "week", "code_module").agg(
        F.avg("score").alias("weekly_score_mean"),
        F.sum("submitted").cast("bigint").alias("weekly_submissions"),
        *[F.max(c).alias(c) for c in ATTRIBUTES],
    )


def weekly_aggregate_sql(events: DataFrame) -> DataFrame:
    """SQL dialect: null keys form their own groups, null scores are skipped."""
    return events.groupBy("id_student", "code_module", "week").agg(
        F.avg("score").alias("weekly_score_mean"),
        F.sum(F.coalesce("submitted", F.lit(1))).cast("bigint").alias("weekly_submissions"),
    )


def weekly_aggregate_from_sources(
    submissions: DataFrame, student_info: DataFrame, assessments: DataFrame, dialect: str = "default"
) -> DataFrame:
    """The same rows as aggregating the clean events, summed before the join."""
    check_dialect(dialect)
    per_week = (
        dated_submissions(submissions, assessments, dialect)
        .groupBy("id_student", "week")
        .agg(F.avg("score").alias("weekly_score_mean"), F.sum("submitted").cast("bigint").alias("_submitted"))
    )
    if dialect == "sql":
        info = student_info.groupBy("id_student", "code_module").agg(F.count("*").alias("_copies"))
        joined = per_week.join(info, "id_student", "left")
        return joined.select(
            "id_student",
            "code_module",
            "week",
            "weekly_score_mean",
            (F.col("_submitted") * F.coalesce("_copies", F.lit(1))).alias("weekly_submissions"),
        )
    if "code_module" not in student_info.columns:
        raise ValueError("info rows without code_module: build the panel with weekly_panel(clean_events(...))")
    keyed = student_info.filter(F.col("id_student").isNotNull() & F.col("code_module").isNotNull())
    present = [c for c in ATTRIBUTES if c in student_info.columns]
    info = keyed.groupBy("id_student", "code_module").agg(
        F.count("*").alias("_copies"), *[F.max(c).alias(c) for c in present]
    )
    return per_week.join(info, "id_student").select(
        "id_student",
        "week",
        "code_module",
        "weekly_score_mean",
        (F.col("_submitted") * F.col("_copies")).alias("weekly_submissions"),
        *[F.col(c) if c in present else F.lit(0).alias(c) for c in ATTRIBUTES],
    )


def running_total(column: str) -> Column:
    return F.sum(column).over(by_week().rowsBetween(W.unboundedPreceding, 0))


def rolling_mean(column: str, rows: int = 3) -> Column:
    """Mean over the last rows present (not calendar weeks), nulls skipped."""
    return F.avg(column).over(by_week().rowsBetween(1 - rows, 0))


def change(column: str) -> Column:
    """Difference to the previous row present; null on the first."""
    return F.col(column) - F.lag(column, 1).over(by_week())


def with_history(weekly: DataFrame, dialect: str = "default") -> DataFrame:
    """Running submissions, rolling mean and change, under each dialect's names."""
    check_dialect(dialect)
    names = (
        ("cum_submissions", "rolling_score_3w", "score_trend_2w")
        if dialect == "default"
        else ("cumulative_submissions", "rolling_3_week_mean", "weekly_score_trend")
    )
    trend = change("weekly_score_mean")
    if dialect == "default":
        trend = F.coalesce(trend, F.lit(0.0))
    return weekly.withColumns(
        {
            names[0]: running_total("weekly_submissions"),
            names[1]: rolling_mean("weekly_score_mean"),
            names[2]: trend,
        }
    )


SCORE_FACTOR = "1 - rolling_score_3w / 100"
SUBMISSION_FACTOR = clip_sql("1 - cum_submissions / (greatest(week, 1) * 1.5D)", 0.0, 1.0)
BACKGROUND = f"1 - {clip_sql('pass_probability_base', 0.05, 0.99)}"


def risk_target() -> Column:
    """Weighted blend of score, submission and background risk, in [0, 1]; null if one is null."""
    blend = f"0.6D * ({SCORE_FACTOR}) + 0.2D * ({SUBMISSION_FACTOR}) + 0.2D * ({BACKGROUND})"
    known = "rolling_score_3w IS NOT NULL AND cum_submissions IS NOT NULL AND pass_probability_base IS NOT NULL"
    return F.expr(f"CASE WHEN {known} THEN {clip_sql(blend, 0.0, 1.0)} END")


def with_target(panel: DataFrame, cut: float = 0.45) -> DataFrame:
    """The risk target and its label; a null target is labelled 0."""
    return panel.withColumn("dropout_risk_target", risk_target()).withColumn(
        "target_high_risk", F.coalesce((F.col("dropout_risk_target") > F.lit(cut)).cast("int"), F.lit(0))
    )


def weekly_panel(events: DataFrame, dialect: str = "default") -> DataFrame:
    """The panel from clean events."""
    if dialect == "sql":
        return with_history(weekly_aggregate_sql(events), "sql")
    return with_target(with_history(weekly_aggregate(events)))


def weekly_panel_from_sources(
    submissions: DataFrame, student_info: DataFrame, assessments: DataFrame, dialect: str = "default"
) -> DataFrame:
    """The panel straight from the staged tables, without the fanned-out events."""
    weekly = weekly_aggregate_from_sources(submissions, student_info, assessments, dialect)
    if dialect == "sql":
        return with_history(weekly, "sql")
    return with_target(with_history(weekly))


def course_target_summary(panel: DataFrame) -> DataFrame:
    """Students, mean target and at-risk share per week and module."""
    return panel.groupBy("week", "code_module").agg(
        F.count("id_student").alias("student_count"),
        F.avg("dropout_risk_target").alias("avg_target"),
        F.avg("target_high_risk").alias("at_risk_share"),
    )
