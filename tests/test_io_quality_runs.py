from __future__ import annotations

import json
from pathlib import Path

import pytest
from conftest import DATA, rows
from pyspark.sql import functions as F

from cohortlens.operators import clicks, marts, models, quality, reports, staging
from cohortlens.params import RunParams
from cohortlens.plans import click_study, daily, sql_chain
from cohortlens.sources import adapters, readers, writers

TS = "2024-02-01 06:30:15"


def write(folder: Path, name: str, text: str) -> None:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def test_required_and_optional_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="studentInfo.csv, studentAssessment.csv, assessments.csv"):
        readers.read_raw_folder(spark, str(tmp_path))
    write(tmp_path, "studentInfo.csv", ' id_student ,"code, module"\n1,"a ""quoted"", cell"\n')
    write(tmp_path, "studentAssessment.csv", "id_student,id_assessment\n1,2\n3,4\n")
    write(tmp_path, "assessments.csv", "id_assessment,date\n1,7\n")
    raw = readers.read_raw_folder(spark, str(tmp_path))
    assert set(raw) == {"student_info", "student_assessment", "assessments"}
    assert raw["student_info"].columns == ["id_student", "code, module"]
    assert raw["student_info"].first()[1] == 'a "quoted", cell'
    assert rows(readers.load_audit(raw)) == [("assessments", 1), ("student_assessment", 2), ("student_info", 1)]


def test_missing_texts_in_the_default_dialect(spark):
    raw = spark.createDataFrame([("7", "NA", "12.5", "2", "x", "1", "0.4")], "id_student string, code_module string, studied_credits string, age_band_num string, imd_band_num string, disability_flag string, pass_probability_base string")
    assert rows(staging.stage_student_info(raw)) == [(7, None, 12.5, 2, None, 1, 0.4)]


def test_catalog_tables(spark):
    writers.create_tables(spark)
    writers.create_tables(spark)
    assert spark.table("mart.course_summary_daily").columns[-1] == "run_date"
    df = spark.createDataFrame([(TS, "none", 0.1, 0.0, "m")], "run_ts string, alert_type string, high_risk_rate double, spike_pct double, message string")
    writers.append_table(df, "mart.alert_log")
    writers.append_table(df.limit(0), "mart.alert_log")
    writers.append_table(df, "mart.alert_log")
    assert spark.table("mart.alert_log").count() == 2
    spark.sql("CREATE TABLE mart.old_summary (code_module STRING) USING parquet")
    spark.sql("INSERT INTO mart.old_summary VALUES ('A')")
    assert writers.add_missing_column(spark, "mart.old_summary", "week", "INT")
    assert not writers.add_missing_column(spark, "mart.old_summary", "week", "INT")
    assert rows(spark.table("mart.old_summary")) == [("A", None)]


def test_partition_overwrite_keeps_other_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "run_date string, v int")
    writers.replace_partitions(df, path)
    writers.replace_partitions(df.filter("v = 2").withColumn("v", F.lit(5)), path)
    assert [r[0] for r in rows(spark.read.parquet(path), "v")] == [1, 5]


def test_quality_results(spark):
    df = spark.createDataFrame([(1, None, 3), (1, 2.0, 3), (None, None, 3)], "id long, s double, week int")
    got = quality.column_checks(df, "t", not_null=["id"], not_all_null=["s"], several=["week"]).unionByName(quality.unique_check(df, "t", "id"))
    assert {(r.check, r.failing_rows, r.passed) for r in got.collect()} == {
        ("not_null", 1, False),
        ("not_all_null", 0, True),
        ("several_values", 1, False),
        ("unique", 1, False),
    }


def test_click_edge_cases(spark):
    click = spark.createDataFrame(
        [("A", "J", 1, -3, 5), ("A", "J", 1, -3, 2), ("A", "J", 1, 60, 4), ("A", "J", 1, 61, 1), ("A", "J", 1, 90, 2), ("A", "J", 1, 91, 100), ("A", "J", 2, 5, 9)],
        "code_module string, code_presentation string, id_student long, date int, sum_click long",
    )
    info = spark.createDataFrame([("A", "J", 1, "Pass"), ("A", "J", 2, "Fail"), ("A", "J", 3, None)], "code_module string, code_presentation string, id_student long, final_result string")
    sub = spark.createDataFrame([(1, None), (1, 80.0), (2, None)], "id_student long, score double")
    got = rows(clicks.study_table(info, click, sub), "id_student", "total_clicks", "early_preview_clicks", "recent_trend_clicks", "avg_assignment_score", "assignment_submission_count", "target")
    assert got == [(1, 14, 7, 3, 80.0, 1, 1), (2, 9, 0, 0, 0.0, 0, 0), (3, 0, 0, 0, 0.0, 0, 0)]
    std = {r.id_student: r.click_stability_std for r in clicks.click_features(click).collect()}
    assert std[2] is None and std[1] == pytest.approx(2.6457513110645907)


def test_course_summary_forms_agree(spark):
    from checkset.queries import risk

    mart = risk(spark, str(DATA))
    distinct, counted = (rows(marts.course_summary(mart, one_row_per_student=flag)) for flag in (False, True))
    assert [d[:4] for d in distinct] == [c[:4] for c in counted]
    assert [d[4:] for d in distinct] == [pytest.approx(c[4:]) for c in counted]


def test_course_counts_add_up(spark):
    from checkset.queries import risk

    mart = risk(spark, str(DATA))
    total = marts.course_summary(mart).agg(F.sum("student_count")).first()[0]
    assert total == mart.select("id_student", "week", "code_module").distinct().count()


def test_latest_run_and_today(spark):
    df = spark.createDataFrame([("2024-01-01", 1, "A", 0.5), ("2024-01-02", 2, "A", 0.4)], "run_date string, id_student long, code_module string, risk_score double").withColumn("run_date", F.col("run_date").cast("date"))
    assert [r.id_student for r in reports.latest_run(df).collect()] == [2]
    assert reports.run_day_top(df).count() == 0
    today = df.withColumn("run_date", F.current_date())
    assert [r.id_student for r in reports.run_day_top(today, n=1).collect()] == [1]


def test_histogram_bounds(spark):
    df = spark.createDataFrame([(0.0,), (0.049,), (0.05,), (1.0,), (None,)], "risk_score double")
    assert rows(reports.risk_histogram(df)) == [(1, 2), (2, 1), (20, 1)]


@pytest.fixture(scope="module")
def inputs(spark):
    d = str(DATA)
    return adapters.student_assessment(spark, d), adapters.student_info(spark, d), staging.stage_assessments(adapters.assessments(spark, d))


def test_daily_run(spark, inputs, tmp_path):
    params = RunParams(split_week=2, n_boot=200)
    passed = clicks.with_outcome(inputs[1]).groupBy("id_student", "code_module").agg(F.max("target").alias("outcome"))
    passed = passed.withColumn("uplift_scenario", F.explode(F.array(*[F.lit(u) for u in params.uplifts])))
    out = str(tmp_path / "run")
    got = daily.run_daily(spark, *inputs, out=out, run_ts=TS, run_id="r1", params=params, outcomes=passed)
    for name in ("metrics", "top_features", "predictions_latest", "student_risk_daily", "course_summary_daily", "student_risk_scores", "alert_log", "assignment_latest", "experiment_results", "roi_sensitivity", "run_summary", "model_metadata"):
        assert list((Path(out) / name).rglob("part-*")), name
    risk = spark.read.parquet(f"{out}/student_risk_daily")
    risk_rows = risk.count()
    assert risk.select("week").distinct().count() > 1
    assert risk.filter("risk_score < 0 OR risk_score > 1 OR risk_score IS NULL").count() == 0
    assert got["course_summary"].select("week").distinct().count() > 1
    metrics = got["metrics"].first()
    assert 0.5 < metrics.auc <= 1 and metrics.model_backend == "logistic"
    assert got["alert"].count() == 1 and got["roi"].count() == 20 and got["experiment"].count() == 3
    document = got["manifest"].first()
    assert document.run_id == "r1" and document.model_backend == "logistic" and len(document.artifacts) >= 9
    meta = json.loads(next((Path(out) / "model_metadata").glob("part-*")).read_text())
    assert meta["split_week"] == 2 and meta["train_rows"] + meta["test_rows"] == got["weekly_panel"].count()
    # a rerun of the same time replaces marts, history, logs and manifest; a later run extends the logs
    kept = ["student_risk_daily", "student_risk_scores", "alert_log", "experiment_results"]
    before = {name: spark.read.parquet(f"{out}/{name}").count() for name in kept}
    daily.run_daily(spark, *inputs, out=out, run_ts=TS, run_id="r1", params=params, outcomes=passed)
    assert {name: spark.read.parquet(f"{out}/{name}").count() for name in kept} == before
    assert spark.read.parquet(f"{out}_manifests").count() == 1
    daily.run_daily(spark, *inputs, out=out, run_ts="2024-03-01 06:30:15", run_id="r2", params=params)
    assert spark.read.parquet(f"{out}/alert_log").count() == 2 and spark.read.parquet(f"{out}_manifests").count() == 2


def test_daily_run_with_another_model(spark, inputs, tmp_path):
    got = daily.run_daily(spark, *inputs, out=str(tmp_path / "run"), run_ts=TS, run_id="r1", params=RunParams(split_week=2, model_name="mlp"))
    assert got["metrics"].first().model_backend == "mlp"
    assert got["top_features"].count() == 9 and "experiment" not in got


@pytest.mark.parametrize("name, options", [("newton", ()), ("boosted", (("trees", 3), ("depth", 3)))])
def test_daily_run_with_own_models(spark, inputs, tmp_path, name, options):
    """Explained by contributions of all rows; the model is saved as a table."""
    out = str(tmp_path / "run")
    got = daily.run_daily(spark, *inputs, out=out, run_ts=TS, run_id="r1", params=RunParams(split_week=2, model_name=name, model_options=options))
    assert got["metrics"].first().model_backend == name and got["metrics"].first().auc > 0.5
    assert got["top_features"].columns == ["feature", "mean_abs_contribution"] and got["top_features"].count() == 9
    saved = spark.read.parquet(f"{out}/model")
    assert saved.columns[0] == ("feature" if name == "newton" else "tree") and saved.count() > 3
    with pytest.raises(ValueError, match="newton"):
        models.train_named(got["weekly_panel"], "oracle", daily.PANEL_KEY)


def test_sql_chain(spark, inputs):
    writers.create_tables(spark)
    submissions, info, _ = inputs
    d = str(DATA)
    writers.land_raw({"student_info": info, "student_assessment": submissions, "assessments": adapters.assessments(spark, d)})
    assert {f.dataType.simpleString() for f in spark.table("raw.student_info").schema} == {"string"}
    from checkset.queries import scores

    writers.append_table(scores(spark, d), "ml.student_risk_scores")
    views = sql_chain.stage_views(spark)
    tables = sql_chain.build_mart_tables(spark, views)
    assert tables["mart_student_risk_weekly"].count() >= scores(spark, d).count()
    assert "mart_alert_log" in tables
    checks = sql_chain.run_tests(views, tables)
    assert checks.count() == 13 and checks.filter("NOT passed").count() == 0
    assert spark.table("int_weekly_student_features").count() > 0


def test_click_study(spark):
    d = str(DATA)
    got = click_study.run_study(
        adapters.student_info(spark, d), adapters.student_vle(spark, d), adapters.student_assessment(spark, d), RunParams(cutoff_day=20, recent_days=7), trees=3
    )
    assert {r.side: r.rows for r in got["sides"].collect()} == {"train": 120, "test": 30}
    assert got["importance"].count() == got["contributions"].count() == 6 and got["report"].count() == 5
    assert {r.tree for r in got["trees"].collect()} == {1, 2, 3}
    points = got["roc_points"].agg(F.max("fpr"), F.max("tpr"), F.min("tpr")).first()
    assert tuple(points) == (1.0, 1.0, 0.0)
