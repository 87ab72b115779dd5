"""Typed staging of the raw text tables, in both dialects.

``default`` parses leniently (what is no number becomes null); ``sql`` casts strictly, so a
bad cell is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions.columns import MISSING_TEXTS, text_to_double
from cohortlens.schemas import (
    ASSESSMENTS,
    OUTPUT_TABLES,
    STUDENT_ASSESSMENT,
    STUDENT_INFO,
    check_dialect,
    struct,
)


def _lenient(df: DataFrame, name: str, target: T.DataType) -> Column:
    cell = F.col(name)
    if not isinstance(df.schema[name].dataType, T.StringType):
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            cell = F.when(~F.isnan(cell), cell)
        return _to_number(cell, target) if isinstance(target, T.NumericType) else cell.cast(target)
    if isinstance(target, T.StringType):
        return F.when(~cell.isin(MISSING_TEXTS), cell)
    if isinstance(target, T.LongType):
        return F.coalesce(cell.try_cast("bigint"), text_to_double(cell).cast("bigint"))
    return _to_number(text_to_double(cell), target)


def _to_number(cell: Column, target: T.DataType) -> Column:
    # days round down, so that a fraction of a day before the start is still before it
    return F.floor(cell).cast(target) if isinstance(target, T.IntegerType) else cell.cast(target)


def _stage(df: DataFrame, ddl: str, dialect: str, renamed: dict[str, str] | None = None) -> DataFrame:
    check_dialect(dialect)
    renamed = renamed or {}
    out = []
    for field in struct(ddl):
        source = renamed.get(field.name, field.name)
        if dialect == "sql":
            out.append(F.col(source).cast(field.dataType).alias(field.name))
        elif source in df.columns:
            out.append(_lenient(df, source, field.dataType).alias(field.name))
    return df.select(*out)


def stage_student_info(raw: DataFrame, dialect: str = "default") -> DataFrame:
    return _stage(raw, STUDENT_INFO, dialect)


def stage_student_assessment(raw: DataFrame, dialect: str = "default") -> DataFrame:
    """A missing ``submitted`` counts as 1."""
    staged = _stage(raw, STUDENT_ASSESSMENT, dialect)
    if "submitted" not in staged.columns:
        return staged.withColumn("submitted", F.lit(1))
    return staged.withColumn("submitted", F.coalesce("submitted", F.lit(1)))


def stage_assessments(raw: DataFrame, dialect: str = "default") -> DataFrame:
    """The due day is named ``assessment_date`` from here on."""
    return _stage(raw, ASSESSMENTS, dialect, {"assessment_date": "date"})


def stage_risk_scores(raw: DataFrame) -> DataFrame:
    """The score history, as read back from a text or table source."""
    return _stage(raw, OUTPUT_TABLES["ml", "student_risk_scores"], "sql")
