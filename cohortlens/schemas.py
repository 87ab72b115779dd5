"""Table schemas. Names and types are fixed values: they are the public data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Staged inputs.
STUDENT_INFO = "id_student BIGINT, code_module STRING, studied_credits DOUBLE, age_band_num INT, imd_band_num INT, disability_flag INT, pass_probability_base DOUBLE"
STUDENT_ASSESSMENT = "id_student BIGINT, id_assessment BIGINT, date_submitted INT, score DOUBLE, is_banked INT, submitted INT"
ASSESSMENTS = "id_assessment BIGINT, assessment_date INT, weight DOUBLE"
STUDENT_VLE = "code_module STRING, code_presentation STRING, id_student BIGINT, id_site BIGINT, date INT, sum_click BIGINT"

# Outputs, keyed by (namespace, table).
OUTPUT_TABLES = {
    ("mart", "student_risk_daily"): "run_date DATE, id_student BIGINT, code_module STRING, week INT, risk_score DOUBLE, high_risk_flag INT, weekly_score_mean DOUBLE, cum_submissions DOUBLE",
    ("mart", "course_summary_daily"): "run_date DATE, week INT, code_module STRING, student_count INT, avg_risk_score DOUBLE, high_risk_rate DOUBLE",
    ("mart", "experiment_results"): "run_ts TIMESTAMP, uplift_scenario DOUBLE, control_rate DOUBLE, treatment_rate DOUBLE, rate_diff DOUBLE, p_value DOUBLE, ci_low DOUBLE, ci_high DOUBLE",
    ("mart", "alert_log"): "run_ts TIMESTAMP, alert_type STRING, high_risk_rate DOUBLE, spike_pct DOUBLE, message STRING",
    ("ml", "student_risk_scores"): "run_date TIMESTAMP, week INT, id_student BIGINT, code_module STRING, risk_score DOUBLE, high_risk_flag INT, model_version STRING, model_backend STRING, threshold DOUBLE, created_at TIMESTAMP",
}
NAMESPACES = ("raw", "stg", "int", "mart", "ml")

# Raw landing: table -> (file, required).
RAW_FILES = {
    "student_info": ("studentInfo.csv", True),
    "student_assessment": ("studentAssessment.csv", True),
    "assessments": ("assessments.csv", True),
    "student_vle": ("studentVle.csv", False),
    "vle": ("vle.csv", False),
    "courses": ("courses.csv", False),
    "student_registration": ("studentRegistration.csv", False),
}

EVENT_COLUMNS = [
    "id_student",
    "code_module",
    "week",
    "score",
    "submitted",
    "studied_credits",
    "age_band_num",
    "imd_band_num",
    "disability_flag",
    "pass_probability_base",
]
ATTRIBUTES = EVENT_COLUMNS[5:]

MODEL_FEATURES = [
    "weekly_score_mean",
    "weekly_submissions",
    "studied_credits",
    "age_band_num",
    "imd_band_num",
    "disability_flag",
    "cum_submissions",
    "rolling_score_3w",
    "score_trend_2w",
]
MODEL_LABEL = "target_high_risk"

CLICK_FEATURES = [
    "total_clicks",
    "click_stability_std",
    "early_preview_clicks",
    "recent_trend_clicks",
    "avg_assignment_score",
    "assignment_submission_count",
]

DIALECTS = ("default", "sql")


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def check_dialect(dialect: str) -> None:
    if dialect not in DIALECTS:
        raise ValueError(f"unknown dialect {dialect!r}, choose one of {DIALECTS}")
