"""One registered query per operator, each over the whole tables of a scale-factor folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions.columns import percent_text
from cohortlens.operators import alerts, boosting, clicks, evaluation, events, experiments, explain, marts, models, newton, quality, reports, scoring, split, staging, weekly
from cohortlens.params import RunParams
from cohortlens.plans import incremental, sql_chain
from cohortlens.schemas import CLICK_FEATURES, MODEL_FEATURES, MODEL_LABEL, STUDENT_VLE
from cohortlens.session import materialise, scratch_path
from cohortlens.sources import adapters, commits, readers, records, stored, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_TS = "2024-02-01 06:30:15"
RUN_DATE = "2024-02-01"
EARLIER_DATE = "2024-01-25"
# The test tables span 30 days, so the study cuts at day 20 with a recent window of 7 days.
CUTOFF, RECENT = 20, 7
SPLIT_WEEK = 2
HEATMAP_MODULES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PANEL_KEY = ["id_student", "code_module", "week"]

# A given coefficient table: scores that do not depend on a training run.
SCORER = scoring.LinearScorer(
    features=MODEL_FEATURES,
    means=[35.0, 6.0, 60.0, 2.0, 5.0, 0.5, 20.0, 35.0, 0.0],
    scales=[15.0, 4.0, 35.0, 0.8, 2.5, 0.5, 14.0, 11.0, 18.0],
    coefficients=[-0.4, -0.2, 0.1, 0.05, -0.05, 0.3, -0.5, -2.0, -0.1],
    intercept=-0.8,
)
EARLIER_SCORER = scoring.LinearScorer(MODEL_FEATURES, SCORER.means, SCORER.scales, SCORER.coefficients, -0.3)


# Trees with few, small rounds, as their SQL spells every round out; and two given trees, a node a row (NODES of boosting).
FEW_TREES = boosting.Settings(trees=3, depth=2, bins=16)
STUDY_KEY = ["id_student", "code_presentation"]
TREE_FEATURES = ["rolling_score_3w", "cum_submissions", "score_trend_2w"]
TWO_TREES = [
    (1, 1, "rolling_score_3w", 40.0, False, 9.0, 50.0, 0.1),
    (1, 2, "cum_submissions", 6.0, False, 4.0, 30.0, 0.4),
    (1, 3, None, None, None, None, 20.0, -0.3),
    (1, 4, None, None, None, None, 12.0, 0.7),
    (1, 5, None, None, None, None, 18.0, 0.15),
    (2, 1, "score_trend_2w", -5.0, True, 6.0, 48.0, -0.05),
    (2, 2, None, None, None, None, 15.0, 0.25),
    (2, 3, "rolling_score_3w", 55.0, True, 3.0, 33.0, -0.2),
    (2, 6, None, None, None, None, 14.0, 0.05),
    (2, 7, None, None, None, None, 19.0, -0.45),
]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating columns rounded, since sums may be taken in any order.

    The small shift moves decimal ties (means of two-digit scores end in 5) off the half.
    """
    return df.selectExpr(
        *[f"round(`{f.name}` + 1e-9D, {digits}) AS `{f.name}`" if isinstance(f.dataType, T.DoubleType) else f"`{f.name}`" for f in df.schema]
    )


# ---- inputs ------------------------------------------------------------------------------


def sources(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Typed submissions, info and assessments."""
    return adapters.student_assessment(spark, d), adapters.student_info(spark, d), staging.stage_assessments(adapters.assessments(spark, d))


def panel(spark: SparkSession, d: str) -> DataFrame:
    return weekly.weekly_panel_from_sources(*sources(spark, d))


def panel_sql(spark: SparkSession, d: str) -> DataFrame:
    return weekly.weekly_panel_from_sources(*sources(spark, d), dialect="sql")


def scored(spark: SparkSession, d: str) -> DataFrame:
    return scoring.score_linear(panel(spark, d), SCORER)


def risk(spark: SparkSession, d: str) -> DataFrame:
    return marts.student_risk(scored(spark, d), RUN_DATE)


def risk_runs(spark: SparkSession, d: str) -> DataFrame:
    """The mart after two runs."""
    rows = panel(spark, d)
    runs = [
        marts.student_risk(scoring.score_linear(rows, scorer), day)
        for scorer, day in ((EARLIER_SCORER, EARLIER_DATE), (SCORER, RUN_DATE))
    ]
    return runs[0].unionByName(runs[1])


def scores(spark: SparkSession, d: str) -> DataFrame:
    return marts.score_history(risk(spark, d), RUN_TS, "logistic", RunParams.risk_threshold)


def joined_mart(spark: SparkSession, d: str) -> DataFrame:
    """Score history with weekly features and student attributes; repeated info rows fan out."""
    return marts.risk_weekly(scores(spark, d), panel_sql(spark, d), staging.stage_student_info(adapters.student_info(spark, d)))


def summary(spark: SparkSession, d: str) -> DataFrame:
    return marts.course_summary(risk_runs(spark, d), one_row_per_student=True)


def snap(spark: SparkSession, d: str) -> DataFrame:
    return scoring.snapshot(scored(spark, d), SPLIT_WEEK)


def study(spark: SparkSession, d: str) -> DataFrame:
    return clicks.study_table(adapters.student_info(spark, d), adapters.student_vle(spark, d), adapters.student_assessment(spark, d), CUTOFF, RECENT)


def evaluated(spark: SparkSession, d: str) -> DataFrame:
    """Scored model rows on the test side of the time split, its week known from the training run."""
    return split.model_rows(scored(spark, d)).filter(F.col("week") >= SPLIT_WEEK).select(*PANEL_KEY, *[c for c in MODEL_FEATURES], MODEL_LABEL, "risk_score")


def training_rows(spark: SparkSession, d: str) -> DataFrame:
    return split.model_rows(panel(spark, d)).filter(F.col("week") < SPLIT_WEEK).select(*PANEL_KEY, *MODEL_FEATURES, MODEL_LABEL)


# what counts as passed differs between the scenarios, so that their outcomes do
PASSED_IN = {0.03: ["Pass", "Distinction"], 0.05: ["Pass", "Distinction", "Fail"], 0.08: ["Distinction", "Withdrawn"]}


def outcomes_by_scenario(info: DataFrame) -> DataFrame:
    """Info rows once per scenario, with the outcome in it."""
    by_scenario = [F.struct(F.lit(u).alias("uplift_scenario"), F.col("final_result").isin(r).cast("int").alias("outcome")) for u, r in PASSED_IN.items()]
    return info.withColumn("_s", F.explode(F.array(*by_scenario))).select("*", "_s.*").drop("_s")


def population_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Observed outcomes of all enrolments; arms are assigned once."""
    arms = experiments.assign_arms(adapters.student_info(spark, d), 42, ["id_student", "code_presentation"])
    return outcomes_by_scenario(arms).select("uplift_scenario", "arm", "outcome")


def cohort(spark: SparkSession, d: str) -> DataFrame:
    """The top-k students of the snapshot with their arm."""
    top = scoring.top_k(snap(spark, d))
    return experiments.assign_arms(top.select("id_student", "code_module", "week", "risk_score"), keys=["id_student", "code_module"])


def cohort_outcomes(spark: SparkSession, d: str) -> DataFrame:
    observed = outcomes_by_scenario(adapters.student_info(spark, d))
    return experiments.observed_outcomes(experiments.expand_scenarios(cohort(spark, d)), observed).select("uplift_scenario", "arm", "outcome")


# ---- staging and events ----------------------------------------------------------------


@query
def stage_student_info(spark, d):
    return rounded(staging.stage_student_info(adapters.as_text(adapters.student_info(spark, d))))


@query
def stage_student_info_sql(spark, d):
    return rounded(staging.stage_student_info(adapters.as_text(adapters.student_info(spark, d)), "sql"))


@query
def stage_student_assessment(spark, d):
    return rounded(staging.stage_student_assessment(adapters.raw_student_assessment(spark, d)))


@query
def stage_student_assessment_sql(spark, d):
    return rounded(staging.stage_student_assessment(adapters.as_text(adapters.student_assessment(spark, d)), "sql"))


@query
def stage_assessments(spark, d):
    return staging.stage_assessments(adapters.as_text(adapters.assessments(spark, d)), "sql")


@query
def stage_risk_scores(spark, d):
    return rounded(staging.stage_risk_scores(adapters.as_text(scores(spark, d))))


@query
def clean_events(spark, d):
    """From raw text, with unreadable scores."""
    submissions = staging.stage_student_assessment(adapters.raw_student_assessment(spark, d))
    _, info, due = sources(spark, d)
    return rounded(events.clean_events(submissions, info, due))


@query
def clean_events_sql(spark, d):
    return rounded(events.clean_events(*sources(spark, d), dialect="sql"))


@query
def dated_submissions(spark, d):
    submissions, _, due = sources(spark, d)
    return rounded(events.dated_submissions(submissions, due))


@query
def events_missing_columns(spark, d):
    """Sources without score, submitted and some attributes: created as 0 (submitted as 1)."""
    submissions, info, due = sources(spark, d)
    return rounded(events.clean_events(submissions.drop("score", "submitted"), info.drop("imd_band_num", "studied_credits"), due))


@query
def events_safe_key(spark, d):
    """Events matched to their info row on student and presentation."""
    submissions, info, due = sources(spark, d)
    keyed = submissions.withColumn("code_presentation", F.when(F.col("id_assessment") % 2 == 0, "2024B").otherwise("2024J"))
    return rounded(events.clean_events(keyed, info, due, on=("id_student", "code_presentation")))


# ---- weekly panel ------------------------------------------------------------------------


@query
def weekly_features(spark, d):
    return rounded(panel(spark, d))


@query
def weekly_features_from_events(spark, d):
    return rounded(weekly.weekly_panel(events.clean_events(*sources(spark, d))))


@query
def weekly_features_sql(spark, d):
    return rounded(panel_sql(spark, d))


@query
def weekly_aggregate(spark, d):
    return rounded(weekly.weekly_aggregate_from_sources(*sources(spark, d)))


@query
def weekly_aggregate_sql(spark, d):
    return rounded(weekly.weekly_aggregate_from_sources(*sources(spark, d), dialect="sql"))


@query
def cum_submissions(spark, d):
    return panel(spark, d).select(*PANEL_KEY, "cum_submissions")


@query
def rolling_score(spark, d):
    return rounded(panel(spark, d).select(*PANEL_KEY, "rolling_score_3w"))


@query
def score_trend(spark, d):
    return rounded(panel(spark, d).select(*PANEL_KEY, "score_trend_2w"))


@query
def score_trend_sql(spark, d):
    return rounded(panel_sql(spark, d).select(*PANEL_KEY, "weekly_score_trend"))


@query
def risk_target(spark, d):
    return rounded(panel(spark, d).select(*PANEL_KEY, "dropout_risk_target", "target_high_risk"))


@query
def course_target_summary(spark, d):
    """Which module has the highest at-risk share each week?"""
    return rounded(weekly.course_target_summary(panel(spark, d)))


@query
def weekly_target_mean(spark, d):
    return rounded(alerts.weekly_target_mean(panel(spark, d)))


@query
def week_over_week(spark, d):
    return rounded(alerts.spike(panel(spark, d)))


# ---- clickstream study -------------------------------------------------------------------


@query
def daily_clicks(spark, d):
    return clicks.daily_clicks(adapters.student_vle(spark, d), CUTOFF)


@query
def click_features(spark, d):
    return rounded(clicks.click_features(adapters.student_vle(spark, d), CUTOFF, RECENT))


@query
def assignment_features(spark, d):
    return rounded(clicks.assignment_features(adapters.student_assessment(spark, d)))


@query
def assignment_features_outer(spark, d):
    parts = clicks.assignment_features(adapters.student_assessment(spark, d))
    averages = parts.select("id_student", "avg_assignment_score").filter(F.col("avg_assignment_score").isNotNull())
    counts = parts.select("id_student", "assignment_submission_count")
    return rounded(clicks.merge_assignment_parts(averages, counts))


@query
def click_study_matrix(spark, d):
    return rounded(study(spark, d))


@query
def click_row_counts(spark, d):
    return clicks.click_row_counts(adapters.student_vle(spark, d), CUTOFF, RECENT)


@query
def target_counts(spark, d):
    return rounded(reports.value_counts(study(spark, d), "target"))


@query
def column_summary(spark, d):
    return rounded(reports.column_summary(study(spark, d), CLICK_FEATURES))


@query
def correlations(spark, d):
    return rounded(reports.correlations(study(spark, d), CLICK_FEATURES))


@query
def preview(spark, d):
    return reports.preview(adapters.student_info(spark, d).select("id_student", "code_presentation", "code_module", "final_result"), ["id_student", "code_presentation"])


# ---- scores and marts --------------------------------------------------------------------


@query
def standardised_features(spark, d):
    rows = scoring.standardise(panel(spark, d))
    return rounded(rows.select(*PANEL_KEY, *[f"z_{c}" for c in MODEL_FEATURES]))


@query
def linear_score(spark, d):
    return rounded(scored(spark, d).select(*PANEL_KEY, "risk_score", "high_risk_flag"))


class LogisticHook:
    """A model from outside: an object with ``predict_proba``."""

    def predict_proba(self, rows):
        z = (rows.to_numpy(dtype=float) - np.array(SCORER.means)) / np.array(SCORER.scales)
        p = 1 / (1 + np.exp(-(SCORER.intercept + z @ np.array(SCORER.coefficients))))
        return np.column_stack([1 - p, p])


@query
def foreign_model_score(spark, d):
    return rounded(scoring.score_foreign(panel(spark, d), LogisticHook()).select(*PANEL_KEY, "risk_score", "high_risk_flag"))


@query
def risk_snapshot(spark, d):
    """No week named: the last one."""
    return rounded(scoring.snapshot(scored(spark, d)).select(*PANEL_KEY, "risk_score", "high_risk_flag"))


@query
def risk_snapshot_week(spark, d):
    return rounded(snap(spark, d).select(*PANEL_KEY, "risk_score", "high_risk_flag"))


@query
def risk_snapshot_absent_week(spark, d):
    """A week without rows falls back to the last one."""
    return rounded(scoring.snapshot(scored(spark, d), 99).select(*PANEL_KEY, "risk_score", "high_risk_flag"))


@query
def scored_order(spark, d):
    return rounded(scoring.scored_order(scored(spark, d)).select(*PANEL_KEY, "risk_score"))


@query
def student_risk_mart(spark, d):
    return rounded(risk(spark, d))


@query
def risk_score_history(spark, d):
    return rounded(scores(spark, d))


@query
def course_summary(spark, d):
    return rounded(marts.course_summary(risk(spark, d), one_row_per_student=True))


@query
def course_summary_distinct(spark, d):
    """The distinct-count form, over two runs of which one is in twice."""
    runs = risk_runs(spark, d)
    return rounded(marts.course_summary(runs.unionByName(risk(spark, d))))


@query
def course_summary_sql(spark, d):
    return rounded(marts.course_summary(joined_mart(spark, d), "sql"))


@query
def risk_weekly_mart(spark, d):
    return rounded(joined_mart(spark, d))


@query
def course_dimension(spark, d):
    return marts.course_dimension(summary(spark, d))


@query
def mart_to_course(spark, d):
    facts = summary(spark, d)
    return rounded(marts.with_course(facts, marts.course_dimension(facts)))


@query
def top_k_at_risk(spark, d):
    return rounded(scoring.top_k(snap(spark, d)).select(*PANEL_KEY, "risk_score"))


@query
def top_ids(spark, d):
    return alerts.top_ids(snap(spark, d))


@query
def run_day_top(spark, d):
    return rounded(reports.run_day_top(risk_runs(spark, d), RUN_DATE))


@query
def course_ranking(spark, d):
    return rounded(reports.course_ranking(summary(spark, d)))


@query
def course_order_by_week(spark, d):
    return rounded(reports.weekly_course_order(summary(spark, d)))


@query
def top_courses(spark, d):
    return rounded(reports.top_courses(summary(spark, d)))


@query
def latest_run(spark, d):
    return rounded(reports.latest_run(risk_runs(spark, d)))


@query
def risk_trend(spark, d):
    return rounded(reports.risk_trend(risk_runs(spark, d)))


@query
def risk_histogram(spark, d):
    return reports.risk_histogram(risk(spark, d))


@query
def module_heatmap(spark, d):
    return rounded(reports.module_rates(marts.course_summary(risk(spark, d), one_row_per_student=True)))


@query
def mart_verification(spark, d):
    return reports.mart_verification(risk(spark, d))


@query
def rows_per_week(spark, d):
    return reports.rows_per_week(risk(spark, d))


# ---- alerts and checks -------------------------------------------------------------------


@query
def snapshot_stats(spark, d):
    return rounded(alerts.snapshot_stats(snap(spark, d)))


@query
def alert_row(spark, d):
    return rounded(alerts.alert_row(snap(spark, d), panel(spark, d), RUN_TS))


@query
def alert_timeline(spark, d):
    """Alert log of both snapshots, newest first."""
    p = panel(spark, d)
    log = alerts.alert_row(scoring.snapshot(scored(spark, d)), p, f"{EARLIER_DATE} 06:30:15").unionByName(alerts.alert_row(snap(spark, d), p, RUN_TS))
    return rounded(marts.alert_listing(reports.alert_timeline(log)))


@query
def quality_checks(spark, d):
    submissions, info, due = sources(spark, d)
    # stored once, as the SQL project does; the summary and the checks read it
    mart = materialise(joined_mart(spark, d), "risk-weekly-mart")
    return quality.all_checks(info, submissions, due, mart, marts.course_summary(mart, "sql"))


@query
def failing_checks(spark, d):
    """Checks that find something: unmatched students and repeated ids."""
    base = events.clean_events(*sources(spark, d), dialect="sql")
    info = adapters.student_info(spark, d)
    return quality.column_checks(base, "events", not_null=["code_module", "id_student", "score"], several=["week"]).unionByName(
        quality.unique_check(info, "student_info", "id_student")
    )


# ---- experiments -------------------------------------------------------------------------


@query
def arm_assignment(spark, d):
    return rounded(experiments.with_base_probability(cohort(spark, d)))


@query
def scenario_grid(spark, d):
    return rounded(experiments.expand_scenarios(cohort(spark, d)))


@query
def arm_rates(spark, d):
    return rounded(experiments.arm_rates(population_outcomes(spark, d)))


@query
def z_test(spark, d):
    return rounded(experiments.z_test(experiments.arm_rates(population_outcomes(spark, d))))


@query
def bootstrap_ci(spark, d):
    return rounded(experiments.bootstrap_ci(experiments.arm_rates(population_outcomes(spark, d))))


@query
def experiment_readout(spark, d):
    return rounded(experiments.experiment_readout(cohort_outcomes(spark, d), RUN_TS))


@query
def experiment_listing(spark, d):
    return rounded(reports.experiment_listing(experiments.experiment_readout(cohort_outcomes(spark, d), RUN_TS)))


@query
def roi_grid(spark, d):
    rates = experiments.arm_rates(cohort_outcomes(spark, d))
    return rounded(experiments.roi_grid(cohort(spark, d), reference=rates))


@query
def roi_grid_by_module(spark, d):
    return rounded(experiments.roi_grid(cohort(spark, d), by=["code_module"]))


@query
def best_roi(spark, d):
    return rounded(experiments.best_roi(experiments.roi_grid(cohort(spark, d))))


@query
def run_summary(spark, d):
    metrics = evaluation.metric_row(evaluated(spark, d), MODEL_LABEL, "risk_score", "logistic")
    return rounded(experiments.run_summary(metrics, experiments.roi_grid(cohort(spark, d))))


# ---- splits and evaluation ---------------------------------------------------------------


@query
def model_rows(spark, d):
    return rounded(split.model_rows(panel(spark, d)).select(*PANEL_KEY, *MODEL_FEATURES, MODEL_LABEL))


@query
def week_range(spark, d):
    return rounded(split.week_range(panel(spark, d)))


@query
def time_split(spark, d):
    return models.side_rows(split.time_split(split.model_rows(panel(spark, d)), SPLIT_WEEK))


@query
def time_split_fallback(spark, d):
    """A wanted week before all rows: the 0.7 quantile decides."""
    return models.side_rows(split.time_split(split.model_rows(panel(spark, d)), -5))


@query
def stratified_split(spark, d):
    key = ["id_student", "code_presentation"]
    return split.stratified_split(study(spark, d), "target", key).select(*key, "code_module", "target", "side")


@query
def row_sample(spark, d):
    return rounded(split.seeded_sample(panel(spark, d), 200, PANEL_KEY).select(*PANEL_KEY, "weekly_score_mean"))


@query
def confusion(spark, d):
    return evaluation.confusion_counts(evaluated(spark, d), MODEL_LABEL, "risk_score")


@query
def precision_recall(spark, d):
    return rounded(evaluation.precision_recall(evaluated(spark, d), MODEL_LABEL, "risk_score"))


@query
def classification_report(spark, d):
    return rounded(evaluation.classification_report(evaluated(spark, d), MODEL_LABEL, "risk_score"))


@query
def roc_auc(spark, d):
    curve = evaluation.score_curve(evaluated(spark, d), MODEL_LABEL, "risk_score")
    return rounded(evaluation.curve_areas(curve).select("auc"))


@query
def pr_auc(spark, d):
    curve = evaluation.score_curve(evaluated(spark, d), MODEL_LABEL, "risk_score")
    return rounded(evaluation.curve_areas(curve).select("pr_auc"))


@query
def roc_points(spark, d):
    curve = evaluation.score_curve(evaluated(spark, d), MODEL_LABEL, "risk_score")
    return rounded(evaluation.roc_points(curve))


@query
def linear_contributions(spark, d):
    return rounded(explain.linear_contributions(split.model_rows(panel(spark, d)), SCORER))


@query
def top_features(spark, d):
    rows = explain.linear_contributions(split.seeded_sample(split.model_rows(panel(spark, d)), 200, PANEL_KEY), SCORER)
    return rounded(explain.top_features(rows, "mean_abs_contribution", 5))


@query
def top_feature_map(spark, d):
    """The top features as one map, opened again; all model rows are explained."""
    rows = explain.linear_contributions(split.model_rows(panel(spark, d)), SCORER)
    as_map = explain.feature_map(explain.top_features(rows, "mean_abs_contribution", 5), "mean_abs_contribution")
    return rounded(as_map.select(F.explode("top_features").alias("feature", "mean_abs_contribution")))


@query
def permutation_importance(spark, d):
    return rounded(explain.permutation_importance(evaluated(spark, d), SCORER, MODEL_LABEL, PANEL_KEY))


@query
def tree_contributions(spark, d):
    """What each feature adds to the margin of each row, for a given model of two trees."""
    model = boosting.BoostedTrees(spark.createDataFrame(TWO_TREES, boosting.NODES), TREE_FEATURES, boosting.Settings(trees=2, depth=2))
    rows = model.contributions(model.score(panel(spark, d)))
    return rounded(rows.select(*PANEL_KEY, "margin", "base", *[F.col("contributions")[f].alias(f) for f in TREE_FEATURES]))


# ---- training: Newton and trees with SQL, the others rows only -----------------------------


@query
def train_newton(spark, d):
    return rounded(models.coefficient_rows(spark, newton.fit_newton(training_rows(spark, d))))


@query
def boosted_trees(spark, d):
    """The nodes of a few trees on the click study."""
    model = boosting.fit_boosted(study(spark, d), CLICK_FEATURES, "target", STUDY_KEY, FEW_TREES)
    return rounded(model.nodes.drop("nulls_left"))


@query
def boosted_importance(spark, d):
    model = boosting.fit_boosted(study(spark, d), CLICK_FEATURES, "target", STUDY_KEY, FEW_TREES)
    return rounded(model.importance())



@query
def train_logistic(spark, d):
    model = models.train(training_rows(spark, d), "logistic")
    return models.coefficient_rows(spark, model.linear())


@query
def train_mlp(spark, d):
    model = models.train(training_rows(spark, d), "mlp")
    return models.side_rows(model.score(evaluated(spark, d).drop("risk_score")).withColumn("side", F.col("high_risk_flag")))


@query
def train_gbt(spark, d):
    """Boosted trees on the click study, all rows and rounds."""
    rows = split.stratified_split(study(spark, d), "target", ["id_student", "code_presentation"])
    model = models.train(rows.filter(F.col("side") == "train"), "gbt", CLICK_FEATURES, "target")
    return models.tree_importance(spark, model)


# ---- sources and sinks, written below the shared folder and read back ----------------------


def _csv_folder(spark, d) -> str:
    folder = scratch_path(spark, "raw")
    tables = {
        "studentInfo.csv": adapters.student_info(spark, d),
        "studentAssessment.csv": adapters.raw_student_assessment(spark, d),
        "assessments.csv": adapters.assessments(spark, d),
        "studentVle.csv": adapters.student_vle(spark, d),
    }
    for name, df in tables.items():
        writers.write_csv(df, f"{folder}/{name}")
    return folder


def _quoted_folder(spark, d) -> str:
    """Events as CSV whose cells hold line breaks, quotes and separators; some records have too few or too many cells."""
    folder = scratch_path(spark, "quoted")
    note = F.concat_ws("", "event_type", F.lit('\n"'), "props", F.lit('", '), F.col("user_id").cast("string"), F.lit("\n"))
    rows = adapters.driver_table(spark, d, "events").select("event_id", note.alias("note"), F.floor("value").cast("bigint").alias("value"))
    short, long = F.col("event_id") % 97 == 0, F.col("event_id") % 89 == 1
    writers.write_csv(rows.where(~short & ~long), f"{folder}/good")
    quoted = F.concat(F.lit('"'), F.replace("note", F.lit('"'), F.lit('""')), F.lit('"'))
    cells = F.concat_ws(",", "event_id", quoted, F.when(~short, F.col("value")), F.when(~short, F.lit("more")))
    bad = rows.where(short | long).select(F.pmod("event_id", F.lit(4)).alias("part"), F.col("event_id").alias("place"), cells.alias("line"))
    # one header a file
    heads = spark.range(4).select(F.col("id").alias("part"), F.lit(-1).cast("bigint").alias("place"), F.lit("event_id,note,value").alias("line"))
    lines = bad.unionByName(heads).repartition(4, "part").sortWithinPartitions("part", "place")
    lines.select("part", "line").write.partitionBy("part").text(f"{folder}/bad")
    return folder


@query
def csv_multiline_scan(spark, d):
    """Cells with line breaks and quotes, read back as they were; malformed records are not among them."""
    return records.read_csv_records(spark, _quoted_folder(spark, d)).rows


@query
def csv_rejects(spark, d):
    """The malformed records, whole."""
    return records.read_csv_records(spark, _quoted_folder(spark, d)).rejects.select("reason", "record")


@query
def landing_audit(spark, d):
    """Rows and rejects per landed table, observed while landing."""
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_audit")
    loads = readers.read_raw_records(spark, _csv_folder(spark, d)) | {"events": records.read_csv_records(spark, _quoted_folder(spark, d))}
    return writers.land_records(loads, "raw_audit", scratch_path(spark, "landing"))


@query
def csv_scan(spark, d):
    """Raw CSV files to weekly features."""
    raw = readers.read_raw_folder(spark, _csv_folder(spark, d))
    staged = (
        staging.stage_student_assessment(raw["student_assessment"]),
        staging.stage_student_info(raw["student_info"]),
        staging.stage_assessments(raw["assessments"]),
    )
    return rounded(weekly.weekly_panel_from_sources(*staged))


@query
def raw_landing(spark, d):
    """Text tables in the catalog, read back by name and staged strictly."""
    spark.sql("CREATE DATABASE IF NOT EXISTS raw")
    tables = {
        "student_info": adapters.student_info(spark, d),
        "student_assessment": adapters.student_assessment(spark, d),
        "assessments": adapters.assessments(spark, d),
    }
    writers.land_raw(tables, "raw", scratch_path(spark, "landing"))
    staged = (
        staging.stage_student_assessment(readers.source_table(spark, "raw", "student_assessment"), "sql"),
        staging.stage_student_info(readers.source_table(spark, "raw", "student_info"), "sql"),
        staging.stage_assessments(readers.source_table(spark, "raw", "assessments"), "sql"),
    )
    return rounded(weekly.weekly_panel_from_sources(*staged, dialect="sql"))


@query
def sql_chain_summary(spark, d):
    """Raw text tables, typed views and mart tables by name; the course summary as stored. The namespaces are this run's own."""
    run = uuid.uuid4().hex
    raw, ml, mart = (f"{kind}_{run}" for kind in ("raw", "ml", "mart"))
    for namespace in (raw, ml, mart):
        spark.sql(f"CREATE DATABASE `{namespace}` LOCATION '{scratch_path(spark, namespace)}'")
    tables = {
        "student_info": adapters.student_info(spark, d),
        "student_assessment": adapters.student_assessment(spark, d),
        "assessments": adapters.assessments(spark, d),
    }
    writers.land_raw(tables, raw)
    scores(spark, d).write.saveAsTable(f"`{ml}`.student_risk_scores")
    views = sql_chain.stage_views(spark, raw, ml)
    return rounded(sql_chain.build_mart_tables(spark, views, mart)["mart_course_summary_weekly"])


@query
def column_evolution(spark, d):
    """A summary table from before it had weeks gains the column; old rows read as null."""
    spark.sql("CREATE DATABASE IF NOT EXISTS mart")
    name = f"mart.summary_{uuid.uuid4().hex}"
    rows = summary(spark, d)
    rows.drop("week").write.option("path", scratch_path(spark, "summary")).saveAsTable(name)
    writers.add_missing_column(spark, name, "week", "INT")
    writers.append_table(rows, name)
    return spark.table(name).groupBy("week").agg(F.count("*").alias("rows"), F.sum("student_count").alias("students"))


@query
def click_csv_scan(spark, d):
    path = f"{scratch_path(spark, 'clicks')}/studentVle.csv"
    writers.write_csv(adapters.student_vle(spark, d), path)
    return rounded(clicks.click_features(readers.read_csv_table(spark, path, STUDENT_VLE), CUTOFF, RECENT))


@query
def load_audit(spark, d):
    return readers.load_audit(readers.read_raw_folder(spark, _csv_folder(spark, d)))


@query
def event_table_sink(spark, d):
    path = scratch_path(spark, "clean-events")
    events.clean_events(*sources(spark, d)).write.mode("overwrite").parquet(path)
    return rounded(spark.read.parquet(path))


@query
def append_sink(spark, d):
    """Two runs appended; the second one twice, as a rerun would, and an empty one."""
    path = scratch_path(spark, "risk-log")
    run = marts.student_risk(scored(spark, d), RUN_DATE)
    writers.append_rows(risk_runs(spark, d), path)
    writers.append_rows(run, path)
    writers.append_rows(run.filter(F.lit(False)), path)
    return spark.read.parquet(path).groupBy("run_date").agg(F.count("*").alias("rows"), F.sum("high_risk_flag").alias("flagged"))


@query
def partition_overwrite_sink(spark, d):
    """Two runs, the second written twice: a rerun replaces its own partition only."""
    path = scratch_path(spark, "risk-by-date")
    writers.replace_partitions(risk_runs(spark, d), path)
    writers.replace_partitions(risk(spark, d), path)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("run_date").cast("date").alias("run_date")).agg(F.count("*").alias("rows"), F.sum("high_risk_flag").alias("flagged"))


RISK_SCHEMA = "run_date DATE, id_student BIGINT, code_module STRING, week INT, risk_score DOUBLE, high_risk_flag INT, weekly_score_mean DOUBLE, cum_submissions DOUBLE"


def _committed_runs(spark, d) -> str:
    """Two runs, the second one twice, and a third that died before its commit."""
    root = scratch_path(spark, "runs")
    rows = panel(spark, d)
    for run_id, scorer, day, ends in (("r1", EARLIER_SCORER, EARLIER_DATE, True), ("r2", SCORER, RUN_DATE, True), ("r2", SCORER, RUN_DATE, True), ("r3", SCORER, "2024-02-08", False)):
        run = commits.Run(spark, root, run_id, day)
        run.write("student_risk", marts.student_risk(scoring.score_linear(rows, scorer), day))
        if ends:
            run.commit()
    return root


@query
def committed_latest_run(spark, d):
    return rounded(commits.newest_run(spark, _committed_runs(spark, d), "student_risk", RISK_SCHEMA))


@query
def committed_history(spark, d):
    """Rows per run that readers see, as read and as the log has them."""
    root = _committed_runs(spark, d)
    seen = commits.read_runs(spark, root, "student_risk", RISK_SCHEMA).groupBy("run_id", "run_date").agg(F.count("*").alias("rows"), F.sum("high_risk_flag").alias("flagged"))
    return seen.join(commits.committed(spark, root).select("run_id", F.col("rows").alias("logged")), "run_id")


@query
def incremental_panel(spark, d):
    """The panel fed in four batches, every seventh submission a batch late."""
    root = scratch_path(spark, "panel-batches")
    submissions, info, due = sources(spark, d)
    lag = F.when(F.pmod(F.hash("id_student", "id_assessment", "date_submitted"), F.lit(7)) == 0, 1).otherwise(0)
    batch = F.least(F.coalesce(F.floor(F.greatest("date_submitted", F.lit(0)) / 10), F.pmod("id_student", F.lit(4))) + lag, F.lit(3))
    dealt = submissions.withColumn("batch", batch)
    for k in range(4):
        incremental.add_batch(spark, root, f"batch-{k}", RUN_DATE, dealt.where(F.col("batch") == k).drop("batch"), info, due)
    return rounded(incremental.read_panel(spark, root, incremental.panel_schema(info)))


@query
def risk_weekly_bucketed(spark, d):
    """The joined mart over tables stored by student and module."""
    spark.sql("CREATE DATABASE IF NOT EXISTS mart")
    tables = {"scores": scores(spark, d), "panel": panel_sql(spark, d), "info": staging.stage_student_info(adapters.student_info(spark, d))}
    names = {k: f"mart.{k}_{uuid.uuid4().hex}" for k in tables}
    for k, df in tables.items():
        stored.store_bucketed(df, names[k], path=scratch_path(spark, f"bucketed-{k}"))
    return rounded(stored.risk_weekly_stored(spark, *names.values()))


@query
def generations_scan(spark, d):
    """Events written three times over with growing columns and types, read as one table."""
    root = scratch_path(spark, "generations")
    events_now = adapters.driver_table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    old = events_now.where("event_id % 3 = 0").selectExpr("cast(event_id AS int) AS event_id", "cast(user_id AS int) AS user_id", "cast(floor(value) AS int) AS value")
    middle = events_now.where("event_id % 3 = 1").selectExpr("event_id", "cast(user_id AS int) AS user_id", "event_type")
    for name, df in (("g1", old), ("g2", middle), ("g3", events_now.where("event_id % 3 = 2"))):
        df.write.parquet(f"{root}/{name}")
    rows = stored.read_generations(spark, [f"{root}/g{k}" for k in (1, 2, 3)], "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE")
    return rounded(rows)


@query
def mart_csv_sample(spark, d):
    path = scratch_path(spark, "risk-sample")
    writers.write_small_csv(scoring.scored_order(risk(spark, d)).limit(500), path)
    return rounded(readers.read_csv_table(spark, path, RISK_SCHEMA))


@query
def assignment_csv(spark, d):
    """The scenario table as CSV, read back."""
    path = scratch_path(spark, "assignment")
    writers.write_small_csv(experiments.expand_scenarios(cohort(spark, d)), path)
    schema = "id_student BIGINT, code_module STRING, week INT, risk_score DOUBLE, arm STRING, base_pass_prob DOUBLE, uplift_scenario DOUBLE, sim_pass_prob DOUBLE"
    return rounded(readers.read_csv_table(spark, path, schema))


@query
def roi_csv(spark, d):
    """The grid as CSV, read back."""
    path = scratch_path(spark, "roi")
    writers.write_small_csv(experiments.roi_grid(cohort(spark, d)), path)
    schema = (
        "top_k_students BIGINT, uplift_assumption DOUBLE, cost_per_student INT, value_per_pass DOUBLE, incremental_passes DOUBLE, roi DOUBLE"
    )
    return rounded(readers.read_csv_table(spark, path, schema))


@query
def snapshot_csv(spark, d):
    path = scratch_path(spark, "snapshot")
    writers.write_csv(snap(spark, d), path)
    return rounded(readers.read_csv_table(spark, path, "id_student BIGINT, code_module STRING, week INT, risk_score DOUBLE"))


@query
def metric_json(spark, d):
    path = scratch_path(spark, "metrics")
    writers.write_json(evaluation.metric_row(evaluated(spark, d), MODEL_LABEL, "risk_score", "logistic"), path)
    schema = "auc DOUBLE, pr_auc DOUBLE, precision_at_0_5 DOUBLE, recall_at_0_5 DOUBLE, confusion_matrix ARRAY<ARRAY<BIGINT>>, model_backend STRING"
    back = spark.read.schema(schema).json(path)
    flat = F.flatten("confusion_matrix")
    return rounded(
        back.select(
            "auc", "pr_auc", "precision_at_0_5", "recall_at_0_5", "model_backend", *[flat[i].alias(n) for i, n in enumerate(["tn", "fp", "fn", "tp"])]
        )
    )


@query
def artifact_manifest(spark, d):
    """Files of a run and their bytes, per report; the reports hold integers only, so SQL knows every byte."""
    folder = scratch_path(spark, "run")
    writers.write_small_csv(reports.rows_per_week(risk(spark, d)), f"{folder}/rows_per_week")
    writers.write_small_csv(reports.value_counts(study(spark, d), "target").drop("share"), f"{folder}/target_counts")
    manifest = writers.artifact_manifest(spark, folder, "run-1", "part-*.csv")
    report = F.element_at(F.split("storage_uri", "/"), -2).alias("report")
    return manifest.groupBy("run_id", report).agg(F.count("*").alias("files"), F.sum("size_bytes").alias("size_bytes"))


@query
def heatmap_pivot(spark, d):
    """Weeks as rows, the modules of the course dimension as columns."""
    facts = marts.course_summary(risk(spark, d), one_row_per_student=True)
    return rounded(reports.module_heatmap(facts, HEATMAP_MODULES))


@query
def output_tables(spark, d):
    """The output tables as declared, two of them filled; per column its type, position and how many values it holds."""
    prefix = f"ddl_{uuid.uuid4().hex}_"
    writers.create_tables(spark, prefix)
    writers.create_tables(spark, prefix)
    writers.append_table(risk_runs(spark, d), f"{prefix}mart.student_risk_daily")
    writers.append_table(marts.course_summary(risk_runs(spark, d), one_row_per_student=True), f"{prefix}mart.course_summary_daily")
    return writers.table_columns(spark, prefix)


@query
def model_save(spark, d):
    """A saved and reloaded model scores like the one in memory."""
    rows = training_rows(spark, d)
    model = models.train(rows, "logistic")
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    again = models.TrainedModel(model.name, models.load_pipeline(path), model.features, model.settings, model.moments)
    both = again.score(rows).withColumn("linear", model.linear().probability())
    return both.agg(F.count("*").alias("rows"), F.count_if(F.abs(F.col("risk_score") - F.col("linear")) > 1e-9).alias("different"))


@query
def risk_message(spark, d):
    """Share of flagged students per week as text."""
    by_week = scored(spark, d).groupBy("week").agg(F.count_if(F.col("high_risk_flag") == 1).alias("flagged"), F.count("*").alias("n"))
    return by_week.select("week", F.concat_ws(" | ", percent_text(F.col("flagged") / F.col("n")), F.col("n").cast("string")).alias("message"))
