"""Tables for reports: student risk, course summary, score history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.params import RunParams
from cohortlens.schemas import check_dialect


def student_risk(scored: DataFrame, run_date: str) -> DataFrame:
    return scored.select(
        F.lit(run_date).cast("date").alias("run_date"),
        "id_student",
        "code_module",
        "week",
        "risk_score",
        "high_risk_flag",
        "weekly_score_mean",
        F.col("cum_submissions").cast("double").alias("cum_submissions"),
    )


def score_history(
    risk: DataFrame, run_ts: str, model_name: str, threshold: float, model_version: str = RunParams.model_version
) -> DataFrame:
    """The score table kept by the SQL project; the run time is a parameter, so reruns agree."""
    stamp = F.date_trunc("second", F.lit(run_ts).cast("timestamp"))
    return risk.select(
        stamp.alias("run_date"),
        "week",
        "id_student",
        "code_module",
        "risk_score",
        "high_risk_flag",
        F.lit(model_version).alias("model_version"),
        F.lit(model_name).alias("model_backend"),
        F.lit(threshold).cast("double").alias("threshold"),
        stamp.alias("created_at"),
    )


def course_summary(risk: DataFrame, dialect: str = "default", one_row_per_student: bool = False) -> DataFrame:
    """Students, mean risk and high-risk share (default) or count (sql) per run, week and module.

    A distinct count moves every student id through a shuffle. Where the rows are known to be
    unique per student, week and module (a panel of one run), ``one_row_per_student`` counts
    rows instead and only one row per group and task is shuffled.
    """
    check_dialect(dialect)
    students = F.count("id_student") if one_row_per_student else F.count_distinct("id_student")
    grouped = risk.groupBy("run_date", "week", "code_module")
    if dialect == "sql":
        return grouped.agg(
            students.alias("students"),
            F.avg("risk_score").alias("avg_risk_score"),
            F.sum("high_risk_flag").cast("bigint").alias("high_risk_students"),
        )
    return grouped.agg(
        students.alias("student_count"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.avg("high_risk_flag").alias("high_risk_rate"),
    )


def risk_weekly(scores: DataFrame, panel_sql: DataFrame, student_info: DataFrame) -> DataFrame:
    """Score history joined to its weekly features and student attributes."""
    features = panel_sql.select(
        "id_student",
        "code_module",
        "week",
        "weekly_score_mean",
        "weekly_submissions",
        "cumulative_submissions",
        "rolling_3_week_mean",
        "weekly_score_trend",
    )
    info = student_info.select(
        "id_student", "code_module", "studied_credits", "age_band_num", "imd_band_num", "disability_flag", "pass_probability_base"
    )
    joined = scores.join(features, ["id_student", "code_module", "week"], "left").join(
        info, ["id_student", "code_module"], "left"
    )
    return joined.select(
        "run_date",
        "week",
        "id_student",
        "code_module",
        "risk_score",
        "high_risk_flag",
        *features.columns[3:],
        *info.columns[2:],
        "model_version",
        "model_backend",
        "threshold",
        "created_at",
    )


def alert_listing(alerts: DataFrame) -> DataFrame:
    return alerts.select("run_ts", "alert_type", "high_risk_rate", "spike_pct", "message")


def course_dimension(mart: DataFrame) -> DataFrame:
    return mart.select("code_module").distinct()


def with_course(mart: DataFrame, dimension: DataFrame) -> DataFrame:
    """Fact rows related to the course dimension."""
    return mart.join(dimension, "code_module")
