"""Data checks: one result row per check, all checks of a table in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHECK_COLUMNS = ["table", "column", "check", "failing_rows", "passed"]


def _result(rows: DataFrame) -> DataFrame:
    return rows.withColumn("passed", F.col("failing_rows") == 0).select(*CHECK_COLUMNS)


def column_checks(
    df: DataFrame, table: str, not_null: Sequence[str] = (), not_all_null: Sequence[str] = (), several: Sequence[str] = ()
) -> DataFrame:
    """Not-null, not-entirely-null and more-than-one-value checks, in one aggregate."""
    measures = {
        **{("not_null", c): F.count_if(F.col(c).isNull()) for c in not_null},
        **{("not_all_null", c): F.when(F.count(c) == 0, 1).otherwise(0) for c in not_all_null},
        **{("several_values", c): F.when(F.min(c) < F.max(c), 0).otherwise(1) for c in several},
    }
    names = {key: f"m{i}" for i, key in enumerate(measures)}
    row = df.agg(*[m.cast("bigint").alias(names[k]) for k, m in measures.items()])
    entries = F.array(
        *[
            F.struct(
                F.lit(table).alias("table"), F.lit(column).alias("column"), F.lit(check).alias("check"), F.col(names[check, column]).alias("failing_rows")
            )
            for check, column in measures
        ]
    )
    return _result(row.select(F.explode(entries).alias("e")).select("e.*"))


def unique_check(df: DataFrame, table: str, column: str) -> DataFrame:
    """Values that occur more than once; nulls are not compared."""
    repeated = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    counted = repeated.agg(F.count("*").alias("failing_rows"))
    return _result(
        counted.select(F.lit(table).alias("table"), F.lit(column).alias("column"), F.lit("unique").alias("check"), "failing_rows")
    )


def all_checks(
    student_info: DataFrame, student_assessment: DataFrame, assessments: DataFrame, risk_weekly: DataFrame, summary_weekly: DataFrame
) -> DataFrame:
    """The data tests of the SQL project."""
    parts = [
        column_checks(student_info, "stg_student_info", not_null=["id_student", "code_module"]),
        column_checks(student_assessment, "stg_student_assessment", not_null=["id_student", "id_assessment"]),
        column_checks(assessments, "stg_assessments", not_null=["id_assessment"]),
        unique_check(assessments, "stg_assessments", "id_assessment"),
        column_checks(
            risk_weekly,
            "mart_student_risk_weekly",
            not_null=["run_date", "risk_score"],
            not_all_null=["risk_score"],
            several=["week"],
        ),
        column_checks(summary_weekly, "mart_course_summary_weekly", not_null=["run_date", "code_module"], several=["week"]),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
