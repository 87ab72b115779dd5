"""One daily run: staged inputs to panel, model, scores, marts, alert, experiment and summary.

The panel and the scores are written once and read back, so each later step scans a table
(with its own columns and filters) and no step recomputes the joins and windows before it.
What reaches the driver is the split week, the feature moments, the fitted model and the
bucket limits of the score curve; everything else goes from table to table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import alerts, evaluation, events, experiments, explain, marts, models, scoring, split, weekly
from cohortlens.params import RunParams
from cohortlens.schemas import MODEL_FEATURES, MODEL_LABEL
from cohortlens.sources import writers

PANEL_KEY = ["id_student", "code_module", "week"]
# The short outputs a manifest lists; the large tables are described by their own folders.
REPORTS = ["metrics", "model_metadata", "top_features", "student_risk_sample", "alert_log", "assignment_latest", "roi_sensitivity", "run_summary"]


def _stored(df: DataFrame, path: str, by: str | None = None) -> DataFrame:
    """Write and read back; ``by`` partitions the files, rebalanced so that none is tiny or huge."""
    if by:
        df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def run_daily(
    spark: SparkSession,
    submissions: DataFrame,
    student_info: DataFrame,
    assessments: DataFrame,
    out: str,
    run_ts: str,
    run_id: str,
    params: RunParams = RunParams(),
    outcomes: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Run all steps into folders below ``out``; ``out`` must be reachable by all executors.

    ``outcomes`` holds observed 0/1 outcomes per student, module and uplift_scenario. Without it the
    experiment is not read out, since outcomes are never invented.
    """
    run_date = run_ts[:10]
    out = out.rstrip("/")
    results: dict[str, DataFrame] = {}

    results["clean_events"] = _stored(events.clean_events(submissions, student_info, assessments), f"{out}/clean_events")
    panel = _stored(weekly.weekly_panel_from_sources(submissions, student_info, assessments), f"{out}/weekly_panel")
    results["weekly_panel"] = panel

    rows = split.model_rows(panel)
    at = split.split_week(rows, params.split_week).first()["split_week"]
    train_rows = rows.filter(F.col("week") < at)
    model = models.train_named(train_rows, params.model_name, PANEL_KEY, seed=params.seed, **dict(params.model_options))
    models.save_model(model, f"{out}/model")

    linear = model.name in ("logistic", "newton")
    if linear:
        scored = scoring.score_linear(panel, model.linear(), params.risk_threshold)
    else:
        scored = model.score(panel, params.risk_threshold)
    # by week: the snapshot and the test side then read their own weeks only
    scored = _stored(scored, f"{out}/scored_panel", by="week")
    results["scored_panel"] = scored

    test_rows = split.model_rows(scored).filter(F.col("week") >= at)
    metrics = _stored(evaluation.metric_row(test_rows, MODEL_LABEL, "risk_score", model.name), f"{out}/metrics_table")
    writers.write_json(metrics, f"{out}/metrics")
    results["metrics"] = metrics
    sizes = rows.agg(F.count_if(F.col("week") < at).alias("train"), F.count_if(F.col("week") >= at).alias("test")).first()
    writers.write_json(
        models.model_metadata(spark, model, at, sizes["train"], sizes["test"], params.seed), f"{out}/model_metadata"
    )

    if linear:
        importance, value = explain.linear_contributions(train_rows, model.linear()), "mean_abs_contribution"
    elif model.name == "boosted":
        importance, value = model.trees.mean_contributions(train_rows), "mean_abs_contribution"
    else:
        importance = explain.permutation_importance(train_rows, model, MODEL_LABEL, PANEL_KEY, seed=params.seed)
        value = "importance"
    top = _stored(explain.top_features(importance, value), f"{out}/top_features_table")
    writers.write_json(explain.feature_map(top, value), f"{out}/top_features")
    results["top_features"] = top

    snap = scoring.snapshot(scored, params.current_week)
    writers.write_csv(snap, f"{out}/predictions_latest")
    results["snapshot"] = snap

    risk = marts.student_risk(scored, run_date)
    writers.replace_partitions(risk, f"{out}/student_risk_daily")
    summary = marts.course_summary(risk, one_row_per_student=True)
    writers.replace_partitions(summary, f"{out}/course_summary_daily")
    history = marts.score_history(risk, run_ts, model.name, params.risk_threshold, params.model_version)
    writers.replace_partitions(history, f"{out}/student_risk_scores")
    writers.write_small_csv(scoring.scored_order(risk).limit(500), f"{out}/student_risk_sample")
    writers.write_csv(summary, f"{out}/course_summary_csv")
    results |= {"student_risk": risk, "course_summary": summary, "score_history": history}

    alert = alerts.alert_row(snap, panel, run_ts, params)
    writers.replace_partitions(alert, f"{out}/alert_log", "run_ts")
    results["alert"] = alert

    top_rows = scoring.top_k(snap, params.top_k)
    cohort = _stored(
        experiments.expand_scenarios(
            experiments.assign_arms(top_rows, params.seed, ["id_student", "code_module"]), params.uplifts
        ),
        f"{out}/assignment_table",
    )
    writers.write_small_csv(cohort, f"{out}/assignment_latest")
    results["assignment"] = cohort
    readout = None
    if outcomes is not None:
        observed = experiments.observed_outcomes(cohort, outcomes)
        readout = _stored(experiments.experiment_readout(observed, run_ts, params), f"{out}/experiment_readout")
        writers.replace_partitions(readout, f"{out}/experiment_results", "run_ts")
        results["experiment"] = readout
    grid = _stored(experiments.roi_grid(top_rows, params, reference=readout), f"{out}/roi_table")
    writers.write_small_csv(grid, f"{out}/roi_sensitivity")
    results["roi"] = grid
    summary_row = experiments.run_summary(metrics, grid)
    writers.write_json(summary_row, f"{out}/run_summary")
    results["run_summary"] = summary_row

    listed = [*REPORTS, "experiment_results"] if readout is not None else REPORTS
    manifest = writers.artifact_manifest(spark, [f"{out}/{name}" for name in listed], run_id, "part-*")
    document = writers.manifest_document(manifest, run_id, run_ts, model.name, out)
    writers.replace_partitions(document, f"{out}_manifests", "run_id")
    results["manifest"] = spark.read.schema(document.schema).parquet(f"{out}_manifests").filter(F.col("run_id") == run_id)
    return results
