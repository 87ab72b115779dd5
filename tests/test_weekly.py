from __future__ import annotations

import random

import pytest
from conftest import rows

from cohortlens.operators import events, weekly

STUDENT = (1, "AAA", 60.0, 1, 2, 0, 0.5)


def test_windows_go_by_row_not_by_week(make_info, make_submissions, make_due):
    sub = make_submissions([(1, 1, d, s, 0, 1) for d, s in [(7, 30.0), (14, 60.0), (49, 90.0), (56, 10.0)]])
    got = rows(weekly.weekly_panel_from_sources(sub, make_info([STUDENT]), make_due([])), "week", "cum_submissions", "rolling_score_3w", "score_trend_2w")
    assert got == [(1, 1, 30.0, 0.0), (2, 2, 45.0, 30.0), (7, 3, 60.0, 30.0), (8, 4, pytest.approx(160 / 3), -80.0)]
    sql = weekly.weekly_panel_from_sources(sub, make_info([STUDENT]), make_due([]), "sql")
    assert rows(sql, "week", "weekly_score_trend")[0] == (1, None)


def test_null_background_gives_null_target_and_label_0(make_info, make_submissions, make_due):
    sub = make_submissions([(1, 1, 7, 0.0, 0, 1)])
    got = weekly.weekly_panel_from_sources(sub, make_info([(1, "AAA", 60.0, 1, 2, 0, None)]), make_due([]))
    assert rows(got, "dropout_risk_target", "target_high_risk") == [(None, 0)]


# Published rows of one run: week, running submissions, rolling score, background probability, target.
PUBLISHED = [
    (10, 5, 0.0, 0.628482969667456, 0.8076367393998422),
    (10, 6, 0.0, 0.34939183014135217, 0.8501216339717296),
    (10, 5, 7.273333333333333, 0.3308029453115812, 0.823532744271017),
    (10, 6, 7.276666666666666, 0.3497310169511731, 0.8063937966097653),
]


def test_target_reproduces_published_rows(spark):
    df = spark.createDataFrame([p[:4] for p in PUBLISHED], "week int, cum_submissions long, rolling_score_3w double, pass_probability_base double")
    got = [(r.dropout_risk_target, r.target_high_risk) for r in weekly.with_target(df.coalesce(1)).collect()]
    assert got == [(pytest.approx(p[4], abs=1e-12), 1) for p in PUBLISHED]


def brute(sub, info, due):
    """Plain loops over the event rows, for the default dialect."""
    due_day = {d[0]: d[1] for d in due}
    groups: dict = {}
    for sid, aid, day, score, _, submitted in sub:
        day = day if day is not None else due_day.get(aid, 0)
        for row in info:
            if row[0] == sid:
                g = groups.setdefault((sid, row[1], day // 7), [0.0, 0, 0])
                g[0] += score or 0.0
                g[1] += 1
                g[2] += 1 if submitted is None else submitted
    out = []
    for key in {k[:2] for k in groups}:
        total, means = 0, []
        for k in sorted(k for k in groups if k[:2] == key):
            s, n, submitted = groups[k]
            total += submitted
            means.append(s / n)
            last = means[-3:]
            trend = means[-1] - means[-2] if len(means) > 1 else 0.0
            out.append((*k, round(means[-1], 9), submitted, total, round(sum(last) / len(last), 9), round(trend, 9)))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_both_ways_match_brute_force_with_a_hot_student(make_info, make_submissions, make_due, seed):
    rng = random.Random(seed)
    ids = [1] * 10 + list(range(1, 25))
    sub = [
        (rng.choice(ids), rng.randrange(8), rng.choice([None, *range(-10, 40)]), rng.choice([None, float(rng.randrange(100))]), 0, rng.choice([None, 0, 1]))
        for _ in range(900)
    ]
    info = [(i, rng.choice("ABC"), 60.0, 1, 2, 0, 0.5) for i in range(1, 20) for _ in range(rng.randrange(1, 4))]
    due = [(a, rng.randrange(50), 1.0) for a in range(5)]
    args = make_submissions(sub), make_info(info), make_due(due)
    names = ["id_student", "code_module", "week", "weekly_score_mean", "weekly_submissions", "cum_submissions", "rolling_score_3w", "score_trend_2w"]
    want = brute(sub, info, due)
    for panel in (weekly.weekly_panel_from_sources(*args), weekly.weekly_panel(events.clean_events(*args))):
        got = rows(panel, *names)
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert [g[3:] for g in got] == [pytest.approx(w[3:], abs=1e-6) for w in want]


def test_panel_invariants(spark):
    from checkset.queries import panel
    from conftest import DATA
    from pyspark.sql import Window as W
    from pyspark.sql import functions as F

    p = panel(spark, str(DATA))
    key = ["id_student", "code_module", "week"]
    assert p.groupBy(*key).count().filter("count > 1").count() == 0
    step = F.col("cum_submissions") - F.lag("cum_submissions").over(W.partitionBy(*key[:2]).orderBy("week"))
    assert p.withColumn("step", step).filter("step < 0").count() == 0
    assert p.filter("dropout_risk_target < 0 OR dropout_risk_target > 1").count() == 0
