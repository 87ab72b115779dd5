from __future__ import annotations

import pytest
from conftest import rows

from cohortlens.operators import events, staging, weekly

STUDENT = (1, "AAA", 60.0, 1, 2, 0, 0.5)


def test_negative_day_by_dialect(make_info, make_submissions, make_due):
    sub, info, due = make_submissions([(1, 1, -3, 50.0, 0, 1)]), make_info([STUDENT]), make_due([(1, 7, 10.0)])
    assert rows(events.clean_events(sub, info, due), "week") == [(-1,)]
    assert rows(events.clean_events(sub, info, due, "sql"), "week") == [(0,)]


@pytest.mark.parametrize("day, floor, trunc", [(-14, -2, -2), (-8, -2, -1), (-7, -1, -1), (-1, -1, 0), (0, 0, 0), (6, 0, 0), (7, 1, 1), (20, 2, 2)])
def test_week_buckets(make_info, make_submissions, make_due, day, floor, trunc):
    sub, due = make_submissions([(1, 1, day, 1.0, 0, 1)]), make_due([])
    assert rows(events.dated_submissions(sub, due), "week") == [(floor,)]
    assert rows(events.dated_submissions(sub, due, "sql"), "week") == [(trunc,)]


def test_missing_date_takes_due_day_then_zero(make_submissions, make_due):
    sub = make_submissions([(1, 1, None, 1.0, 0, 1), (2, 99, None, 1.0, 0, 1)])
    assert rows(events.dated_submissions(sub, make_due([(1, 15, 10.0)])), "id_student", "week") == [(1, 2), (2, 0)]


def test_text_scores(spark):
    raw = spark.createDataFrame(
        [("1", "1", "3", s, "0", None) for s in ["78", " 5 ", "?", "", "NaN", "1d", "1e2", None]],
        "id_student string, id_assessment string, date_submitted string, score string, is_banked string, submitted string",
    )
    staged = staging.stage_student_assessment(raw)
    got = [r.score for r in events.dated_submissions(staged, spark.createDataFrame([], "id_assessment long, assessment_date int")).collect()]
    assert sorted(got) == [0.0, 0.0, 0.0, 0.0, 0.0, 5.0, 78.0, 100.0]
    assert {r.submitted for r in staged.collect()} == {1}


def test_bad_number_is_an_error_in_sql(spark):
    raw = spark.createDataFrame(
        [("1", "1", "3", "?", "0", "1")],
        "id_student string, id_assessment string, date_submitted string, score string, is_banked string, submitted string",
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stage_student_assessment(raw, "sql").collect()


def test_fraction_of_a_day_before_the_start(spark):
    raw = spark.createDataFrame([("1", "1", "-0.5", "7.5", "0", "1")], "id_student string, id_assessment string, date_submitted string, score string, is_banked string, submitted string")
    staged = staging.stage_student_assessment(raw)
    due = spark.createDataFrame([], "id_assessment long, assessment_date int")
    assert rows(events.dated_submissions(staged, due), "week", "score") == [(-1, 7.5)]


def test_null_score_is_zero_or_skipped(make_info, make_submissions, make_due):
    sub = make_submissions([(1, 1, 3, None, 0, 1), (1, 1, 4, 80.0, 0, 1)])
    info, due = make_info([STUDENT]), make_due([])
    assert rows(weekly.weekly_panel_from_sources(sub, info, due), "weekly_score_mean") == [(40.0,)]
    assert rows(weekly.weekly_panel_from_sources(sub, info, due, "sql"), "weekly_score_mean") == [(80.0,)]


def test_student_without_info(make_info, make_submissions, make_due):
    sub, info, due = make_submissions([(9, 1, 3, 50.0, 0, 1), (1, 1, 3, 50.0, 0, 1)]), make_info([STUDENT]), make_due([])
    for panel in (weekly.weekly_panel_from_sources(sub, info, due), weekly.weekly_panel(events.clean_events(sub, info, due))):
        assert rows(panel, "id_student") == [(1,)]
    assert rows(weekly.weekly_panel_from_sources(sub, info, due, "sql"), "id_student", "code_module") == [(1, "AAA"), (9, None)]


def test_two_info_rows_fan_out(make_info, make_submissions, make_due):
    sub, due = make_submissions([(1, 1, 3, 50.0, 0, 1)]), make_due([])
    info = make_info([STUDENT, (1, "AAA", 90.0, 1, 2, 0, 0.7), (1, "BBB", 30.0, 1, 2, 0, 0.2)])
    assert events.clean_events(sub, info, due).count() == 3
    got = rows(weekly.weekly_panel_from_sources(sub, info, due), "code_module", "weekly_submissions", "studied_credits")
    assert got == [("AAA", 2, 90.0), ("BBB", 1, 30.0)]


def test_missing_columns_become_zero(make_info, make_submissions, make_due):
    sub = make_submissions([(1, 1, 3, 50.0, 0, None)]).drop("score", "submitted")
    got = events.clean_events(sub, make_info([STUDENT]).drop("imd_band_num"), make_due([]))
    assert rows(got, "score", "submitted", "imd_band_num") == [(0.0, 1, 0)]


def test_safe_key(spark, make_submissions, make_info, make_due):
    from pyspark.sql import functions as F

    sub = make_submissions([(1, 1, 3, 50.0, 0, 1)]).withColumn("code_module", F.lit("BBB"))
    info = make_info([STUDENT, (1, "BBB", 30.0, 1, 2, 0, 0.2)])
    got = events.clean_events(sub, info, make_due([]), on=("id_student", "code_module"))
    assert rows(got, "code_module", "studied_credits") == [("BBB", 30.0)]


def test_unknown_dialect(make_submissions, make_due):
    with pytest.raises(ValueError, match="dialect"):
        events.dated_submissions(make_submissions([]), make_due([]), "oracle")
