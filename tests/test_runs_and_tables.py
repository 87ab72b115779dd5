"""Commit log, incremental panel, co-located marts, files of several generations."""

from __future__ import annotations

import random

import pytest
from conftest import DATA, rows
from pyspark.sql import functions as F

from checkset import queries as q
from cohortlens.operators import marts, weekly
from cohortlens.plans import incremental
from cohortlens.sources import commits, stored

ROW = "k BIGINT, v STRING"


def one_run(spark, root, run_id, day, values):
    run = commits.Run(spark, root, run_id, day)
    run.write("a", spark.createDataFrame(list(enumerate(values)), ROW))
    run.write("b", spark.createDataFrame([(len(values), day)], ROW))
    return run


def test_a_run_is_seen_whole_or_not_at_all(spark, tmp_path):
    root = str(tmp_path)
    assert rows(commits.newest_run(spark, root, "a", ROW)) == [] and rows(commits.read_runs(spark, root, "a", ROW)) == []
    one_run(spark, root, "r1", "2024-01-01", "xy").commit()
    one_run(spark, root, "r2", "2024-01-08", "z")  # dies before its commit
    commits.Run(spark, root, "r3", "2024-01-09").write("a", spark.createDataFrame([(7, "half")], ROW))
    assert rows(commits.newest_run(spark, root, "a", ROW)) == [(0, "x"), (1, "y")]
    one_run(spark, root, "r2", "2024-01-08", "zz").commit()
    one_run(spark, root, "r2", "2024-01-08", "zzz").commit()  # a rerun takes its place
    assert rows(commits.newest_run(spark, root, "a", ROW)) == [(0, "z"), (1, "z"), (2, "z")]
    assert rows(commits.newest_run(spark, root, "a", ROW, "2024-01-01")) == [(0, "x"), (1, "y")]
    assert rows(commits.read_runs(spark, root, "a", ROW).groupBy("run_id").count()) == [("r1", 2), ("r2", 3)]
    found = commits.committed(spark, root).where("table = 'a'").select("run_id", F.col("run_date").cast("string"), "rows")
    assert rows(found) == [("r1", "2024-01-01", 2), ("r2", "2024-01-08", 3)]


def test_the_newest_run_is_known_without_reading_a_table(spark, tmp_path):
    root = str(tmp_path)
    for n in range(3):
        one_run(spark, root, f"r{n}", f"2024-01-0{n + 1}", "ab").commit()
    files = commits.newest_run(spark, root, "a", ROW).inputFiles()
    assert files and all("/a/r2-" in f for f in files)


SUBMISSION = "id_student long, id_assessment long, date_submitted int, score double, is_banked int, submitted int"


def history(seed, late_share):
    """Submissions of 25 students over 12 weeks, in batches by week; some come later than their week."""
    rng = random.Random(seed)
    out = []
    for _ in range(500):
        week = rng.randint(-1, 11)
        batch = max(0, week) // 2 + (rng.randint(1, 3) if rng.random() < late_share else 0)
        student = None if rng.random() < 0.02 else rng.randint(1, 25)
        out.append((min(batch, 7), (student, rng.choice([1, 2, None]), week * 7 + rng.randint(0, 6), rng.choice([None, 10.0, 55.5, 90.0]), 0, rng.choice([0, 1, None]))))
    return out


def inputs(spark):
    info = [(i, m, 60.0, i % 3, None, 0, 0.5 if i % 4 else None) for i in range(1, 24) for m in ("A", "B")[: 1 + i % 2]] + [(3, "A", 90.0, 1, 2, 1, 0.1)]
    schema = "id_student long, code_module string, studied_credits double, age_band_num int, imd_band_num int, disability_flag int, pass_probability_base double"
    return spark.createDataFrame(info, schema), spark.createDataFrame([(1, 10, 5.0), (2, 30, 5.0)], "id_assessment long, assessment_date int, weight double")


def same_panel(got, want):
    columns = [f.split(" ")[0] for f in "id_student,code_module,week".split(",")] + [c for c in want.columns if c not in ("id_student", "code_module", "week")]
    a, b = ({r[:3]: r[3:] for r in (tuple(x) for x in df.select(columns).collect())} for df in (got, want))
    assert set(a) == set(b) and got.count() == len(a)
    for k, v in b.items():
        assert a[k] == tuple(x if x is None else pytest.approx(x) for x in v), k


@pytest.mark.parametrize("late_share", [0.0, 0.15])
def test_batches_add_up_to_the_full_panel(spark, tmp_path, late_share, monkeypatch):
    root, (info, due) = str(tmp_path / "p"), inputs(spark)
    every = history(5, late_share)
    asked = []
    read = incremental.read_runs
    monkeypatch.setattr(incremental, "read_runs", lambda s, r, table, schema, runs=None: asked.append((table, runs)) or read(s, r, table, schema, runs))
    for batch in sorted({b for b, _ in every}):
        part = spark.createDataFrame([r for b, r in every if b == batch], SUBMISSION)
        incremental.add_batch(spark, root, f"b{batch}", "2024-01-01", part, info, due)
        if batch == 2:  # the last batch again, as a rerun would
            incremental.add_batch(spark, root, f"b{batch}", "2024-01-01", part, info, due)
    if late_share == 0:
        assert {t for t, _ in asked} == {"carry"} and all(len(runs) <= 1 for _, runs in asked)
    else:
        assert {t for t, _ in asked} == {"carry", "sums"}
    schema = incremental.panel_schema(info)
    want = weekly.weekly_panel_from_sources(spark.createDataFrame([r for _, r in every], SUBMISSION), info, due)
    same_panel(incremental.read_panel(spark, root, schema), want)
    with pytest.raises(ValueError, match="comes before"):
        incremental.add_batch(spark, root, "b0", "2024-01-01", part, info, due)


def test_marts_stored_by_student_and_module_join_without_a_shuffle(spark, tmp_path):
    scores, panel = q.scores(spark, str(DATA)), q.panel_sql(spark, str(DATA))
    info = q.staging.stage_student_info(q.adapters.student_info(spark, str(DATA)))
    names = []
    for name, df in (("scores", scores), ("panel", panel), ("info", info)):
        names.append(f"default.stored_{name}")
        stored.store_bucketed(df, names[-1], buckets=6, path=str(tmp_path / name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = stored.risk_weekly_stored(spark, *names)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
        again = spark.table(names[1]).withColumn("total", F.sum("weekly_submissions").over(weekly.by_week()))
        assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString()
        assert rows(q.rounded(joined)) == rows(q.rounded(marts.risk_weekly(scores, panel, info)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_generations_of_files(spark, tmp_path):
    a, b, c = (str(tmp_path / x) for x in "abc")
    spark.createDataFrame([(1, 2.5)], "id int, score float").write.parquet(a)
    spark.createDataFrame([(2**40, "x")], "id bigint, note string").write.parquet(b)
    schema = "id BIGINT, score DOUBLE, note STRING"
    assert rows(stored.read_generations(spark, [a, b], schema)) == [(1, 2.5, None), (2**40, None, "x")]
    with pytest.raises(ValueError, match="id is bigint, which int cannot hold"):
        stored.read_generations(spark, [a, b], "id INT, score DOUBLE, note STRING")
    spark.createDataFrame([("7",)], "id string").write.parquet(c)
    with pytest.raises(ValueError, match="id is string"):
        stored.read_generations(spark, [a, c], schema)
    with pytest.raises(ValueError, match="not declared: score"):
        stored.read_generations(spark, [a], "id BIGINT")
    plan = stored.read_generations(spark, [a, b], schema).where("id > 5").select("id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [IsNotNull(id), GreaterThan(id,5)]") >= 1 and "note" not in plan.split("ReadSchema")[-1]
    assert rows(stored.read_generations(spark, [], schema)) == []
