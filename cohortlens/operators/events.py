"""Clean events: submissions with their week and the student's attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions.columns import floor_week, text_to_double, truncated_week
from cohortlens.schemas import ATTRIBUTES, EVENT_COLUMNS, check_dialect


def number_or_zero(df: DataFrame, name: str) -> Column:
    """A numeric column with everything unparsable or missing as 0.0."""
    if name not in df.columns:
        return F.lit(0.0)
    cell = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.coalesce(text_to_double(cell), F.lit(0.0))
    cell = cell.cast("double")
    return F.when(cell.isNull() | F.isnan(cell), F.lit(0.0)).otherwise(cell)


def dated_submissions(
    submissions: DataFrame,
    assessments: DataFrame,
    dialect: str = "default",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Submissions with week, score and submitted flag; the due day stands in for a missing date.

    The join leaves the choice of strategy to Spark: the assessments side is broadcast only
    when its known or measured size is below the session's limit, and otherwise a skewed
    assessment is split at run time.
    """
    check_dialect(dialect)
    due = assessments.select("id_assessment", "assessment_date")
    joined = submissions.join(due, "id_assessment", "left")
    day = F.coalesce(F.col("date_submitted"), F.col("assessment_date"), F.lit(0))
    if "submitted" in submissions.columns:
        submitted = F.coalesce(F.col("submitted").cast("int"), F.lit(1))
    else:
        submitted = F.lit(1)
    if dialect == "sql":
        week, score = truncated_week(day), F.col("score")
    else:
        week, score = floor_week(day), number_or_zero(submissions, "score")
    return joined.select(
        "id_student", *keep, week.alias("week"), score.alias("score"), submitted.alias("submitted")
    )


def clean_events(
    submissions: DataFrame,
    student_info: DataFrame,
    assessments: DataFrame,
    dialect: str = "default",
    on: Sequence[str] = ("id_student",),
) -> DataFrame:
    """One row per submission and matching info row.

    By default the info row is matched on the student alone, so a student with several info
    rows fans out; name more columns in ``on`` for the safe key. A hot student is split by
    Spark's skew join, which may cut the submissions side of this left join anywhere.
    Columns the sources lack become 0 in the default dialect.
    """
    extra = [c for c in on if c != "id_student"]
    dated = dated_submissions(submissions, assessments, dialect, extra)
    if dialect == "sql":
        wanted = ["id_student", "code_module"]
        output = ["id_student", "code_module", "week", "score", "submitted"]
    else:
        wanted = ["id_student", "code_module", *ATTRIBUTES]
        output = EVENT_COLUMNS
    info = student_info.select(*[c for c in dict.fromkeys([*wanted, *extra]) if c in student_info.columns])
    joined = dated.join(info, list(on), "left")
    return joined.select(*[F.col(c) if c in joined.columns else F.lit(0).alias(c) for c in output])
