"""The SQL project's chain over catalog tables: staging and intermediate views, mart tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.operators import marts, quality, staging, weekly
from cohortlens.sources.readers import source_table


def stage_views(spark: SparkSession, raw: str = "raw", ml: str = "ml") -> dict[str, DataFrame]:
    """Typed views over the raw tables and the score history (plan fragments, nothing stored)."""
    views = {
        "stg_student_info": staging.stage_student_info(source_table(spark, raw, "student_info"), "sql"),
        "stg_student_assessment": staging.stage_student_assessment(source_table(spark, raw, "student_assessment"), "sql"),
        "stg_assessments": staging.stage_assessments(source_table(spark, raw, "assessments"), "sql"),
        "stg_ml_student_risk_scores": staging.stage_risk_scores(source_table(spark, ml, "student_risk_scores")),
    }
    views["int_weekly_student_features"] = weekly.weekly_panel_from_sources(
        views["stg_student_assessment"], views["stg_student_info"], views["stg_assessments"], dialect="sql"
    )
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views


def build_mart_tables(spark: SparkSession, views: dict[str, DataFrame], mart: str = "mart") -> dict[str, DataFrame]:
    """Replace the weekly mart tables; the course summary reads the stored risk mart."""
    risk = marts.risk_weekly(
        views["stg_ml_student_risk_scores"], views["int_weekly_student_features"], views["stg_student_info"]
    )
    risk.write.mode("overwrite").saveAsTable(f"`{mart}`.mart_student_risk_weekly")
    stored = source_table(spark, mart, "mart_student_risk_weekly")
    marts.course_summary(stored, "sql").write.mode("overwrite").saveAsTable(f"`{mart}`.mart_course_summary_weekly")
    tables = {
        "mart_student_risk_weekly": stored,
        "mart_course_summary_weekly": source_table(spark, mart, "mart_course_summary_weekly"),
    }
    if spark.catalog.tableExists(f"`{mart}`.alert_log"):
        tables["mart_alert_log"] = marts.alert_listing(source_table(spark, mart, "alert_log"))
    return tables


def run_tests(views: dict[str, DataFrame], tables: dict[str, DataFrame]) -> DataFrame:
    """All data tests of the chain as result rows."""
    return quality.all_checks(
        views["stg_student_info"],
        views["stg_student_assessment"],
        views["stg_assessments"],
        tables["mart_student_risk_weekly"],
        tables["mart_course_summary_weekly"],
    )
