"""Clickstream features up to a cutoff day, and the study table built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.params import RunParams
from cohortlens.schemas import CLICK_FEATURES

ENROLMENT = ["code_module", "code_presentation", "id_student"]


def before_cutoff(clicks: DataFrame, cutoff_day: int) -> DataFrame:
    return clicks.filter(F.col("date") <= F.lit(cutoff_day))


def daily_clicks(clicks: DataFrame, cutoff_day: int = RunParams.cutoff_day) -> DataFrame:
    """Clicks per enrolment and day; rows with a null key are dropped."""
    keyed = before_cutoff(clicks, cutoff_day).dropna(subset=ENROLMENT)
    return keyed.groupBy(*ENROLMENT, "date").agg(F.sum("sum_click").cast("bigint").alias("day_clicks"))


def click_features(
    clicks: DataFrame, cutoff_day: int = RunParams.cutoff_day, recent_days: int = RunParams.recent_days
) -> DataFrame:
    """Four features in one pass over the daily sums.

    A feature without any matching day is null here and becomes 0 in the study table.
    """
    day, clicked = F.col("date"), F.col("day_clicks")
    return daily_clicks(clicks, cutoff_day).groupBy(*ENROLMENT).agg(
        F.sum(clicked).alias("total_clicks"),
        F.stddev_samp(clicked).alias("click_stability_std"),
        F.sum(F.when(day < 0, clicked)).alias("early_preview_clicks"),
        F.sum(F.when(day > F.lit(cutoff_day - recent_days), clicked)).alias("recent_trend_clicks"),
    )


def assignment_features(submissions: DataFrame) -> DataFrame:
    """Mean score and number of scored submissions per student; not cut at the cutoff day."""
    return submissions.filter(F.col("id_student").isNotNull()).groupBy("id_student").agg(
        F.avg("score").alias("avg_assignment_score"),
        F.count("score").alias("assignment_submission_count"),
    )


def merge_assignment_parts(averages: DataFrame, counts: DataFrame) -> DataFrame:
    """Full outer merge of the two assignment features when they come as separate tables."""
    return averages.join(counts, "id_student", "outer")


def with_outcome(df: DataFrame) -> DataFrame:
    """1 for a passed course, else 0 (an unknown result is not passed)."""
    passed = F.col("final_result").isin("Pass", "Distinction")
    return df.withColumn("target", F.coalesce(passed, F.lit(False)).cast("int"))


def study_table(
    student_info: DataFrame,
    clicks: DataFrame,
    submissions: DataFrame,
    cutoff_day: int = RunParams.cutoff_day,
    recent_days: int = RunParams.recent_days,
) -> DataFrame:
    """Every enrolment with its features and outcome; missing numbers are 0.

    Both joined sides are already one row per key, so no key is hot after the aggregation.
    """
    joined = (
        student_info.select(*ENROLMENT, "final_result")
        .join(click_features(clicks, cutoff_day, recent_days), ENROLMENT, "left")
        .join(assignment_features(submissions), "id_student", "left")
    )
    return with_outcome(joined.fillna(0, subset=CLICK_FEATURES)).select(
        *ENROLMENT, "final_result", *CLICK_FEATURES, "target"
    )


def click_row_counts(clicks: DataFrame, cutoff_day: int, recent_days: int) -> DataFrame:
    """Rows in all, before the cutoff, before the start and in the recent window, in one pass."""
    day = F.col("date")
    kept = day <= F.lit(cutoff_day)

    def rows(condition):
        return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")

    return clicks.agg(
        F.count("*").alias("all_rows"),
        rows(kept).alias("cutoff_rows"),
        rows(kept & (day < 0)).alias("early_rows"),
        rows(kept & (day > F.lit(cutoff_day - recent_days))).alias("recent_rows"),
    )
