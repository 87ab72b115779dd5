"""Learner-shaped views over the driver's star-schema tables; every view reads its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FIRST_DAY = "2024-01-08"
# Which module an event type stands for.
MODULE_OF_TYPE = {
    "view": "AUTOMOBILE",
    "click": "BUILDING",
    "purchase": "FURNITURE",
    "signup": "HOUSEHOLD",
    "error": "MACHINERY",
}
# Known schemas: no footer is read to plan a query, and only the named columns are scanned.
DRIVER_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
}
DAY = f"datediff(CAST(ts AS DATE), DATE '{FIRST_DAY}')"


def driver_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def student_vle(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks: one row per event."""
    modules = " ".join(f"WHEN '{kind}' THEN '{module}'" for kind, module in MODULE_OF_TYPE.items())
    return driver_table(spark, folder, "events").selectExpr(
        f"CASE event_type {modules} ELSE 'OTHER' END AS code_module",
        "IF(event_id % 2 = 0, '2024B', '2024J') AS code_presentation",
        "user_id AS id_student",
        "event_id % 20 AS id_site",
        f"{DAY} AS date",
        "CAST(floor(value) AS BIGINT) AS sum_click",
    )


def student_assessment(spark: SparkSession, folder: str) -> DataFrame:
    """Submissions: one row per event, with missing dates, scores and submitted flags."""
    return driver_table(spark, folder, "events").selectExpr(
        "user_id AS id_student",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS id_assessment",
        f"IF(event_id % 10 <> 0, {DAY}, NULL) AS date_submitted",
        "IF(event_type <> 'error', least(value, 100.0D), NULL) AS score",
        "0 AS is_banked",
        "CASE event_type WHEN 'error' THEN 0 WHEN 'signup' THEN NULL ELSE 1 END AS submitted",
    )


def assessments(spark: SparkSession, folder: str) -> DataFrame:
    """Raw assessments; ids start at 10, so the lowest ids of the submissions stay unmatched."""
    return driver_table(spark, folder, "part").selectExpr("p_partkey + 10 AS id_assessment", "p_size AS date", "10.0D AS weight")


def student_info(spark: SparkSession, folder: str) -> DataFrame:
    """Two info rows per student (one per presentation); the lowest student ids have none."""
    return driver_table(spark, folder, "customer").selectExpr(
        "c_custkey DIV 2 + 5 AS id_student",
        "c_mktsegment AS code_module",
        "IF(c_custkey % 2 = 0, '2024B', '2024J') AS code_presentation",
        "CAST(floor(abs(c_acctbal)) % 120 AS DOUBLE) AS studied_credits",
        "CAST(c_custkey % 3 + 1 AS INT) AS age_band_num",
        "CAST(c_nationkey % 9 + 1 AS INT) AS imd_band_num",
        "CAST(c_custkey DIV 3 % 2 AS INT) AS disability_flag",
        "IF(c_custkey % 17 <> 0, 0.15D + CAST(c_custkey % 80 AS DOUBLE) / 100.0D, NULL) AS pass_probability_base",
        "CASE c_custkey % 4 WHEN 0 THEN 'Pass' WHEN 1 THEN 'Fail' WHEN 2 THEN 'Withdrawn' ELSE 'Distinction' END AS final_result",
    )


def as_text(df: DataFrame) -> DataFrame:
    """The same rows with every column as text, as a raw landing holds them."""
    return df.selectExpr(*[f"CAST(`{c}` AS STRING) AS `{c}`" for c in df.columns])


def raw_student_assessment(spark: SparkSession, folder: str) -> DataFrame:
    """Text submissions in which the plainly submitted scores above 60 read as ``?``."""
    typed = student_assessment(spark, folder)
    return typed.selectExpr(
        *[
            "IF(submitted = 1 AND score > 60, '?', CAST(score AS STRING)) AS score" if c == "score" else f"CAST(`{c}` AS STRING) AS `{c}`"
            for c in typed.columns
        ]
    )
