"""The clickstream study: features to a cutoff day, split, boosted trees, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators import boosting, clicks, evaluation, models, reports, split
from cohortlens.params import RunParams
from cohortlens.schemas import CLICK_FEATURES
from cohortlens.session import materialise

CUT = 0.5


def run_study(
    student_info: DataFrame, vle: DataFrame, submissions: DataFrame, params: RunParams = RunParams(), trees: int = 200, depth: int = 6
) -> dict[str, DataFrame]:
    """All tables of the study; features and split rows are written once and read by the later steps."""
    table = clicks.study_table(student_info, vle, submissions, params.cutoff_day, params.recent_days)
    # the split reads its input for the bucket sizes and twice for the rows
    table = materialise(table, "click-features")
    rows = materialise(split.stratified_split(table, "target", clicks.ENROLMENT, seed=params.seed), "click-study")
    train_rows = rows.filter(F.col("side") == "train")
    settings = boosting.Settings(trees=trees, depth=depth, seed=params.seed)
    model = boosting.fit_boosted(train_rows, CLICK_FEATURES, "target", clicks.ENROLMENT, settings)
    test_rows = rows.filter(F.col("side") == "test")
    scored = materialise(model.score(test_rows, CUT).select(*clicks.ENROLMENT, "target", F.col("risk_score").alias("score")), "click-scores")
    curve = evaluation.score_curve(scored, "target", "score")
    return {
        "rows": rows,
        "sides": models.side_rows(rows),
        "target_counts": reports.value_counts(rows, "target"),
        "column_summary": reports.column_summary(rows, CLICK_FEATURES),
        "correlations": reports.correlations(train_rows, CLICK_FEATURES),
        "scored": scored,
        "confusion": evaluation.confusion_counts(scored, "target", "score", CUT),
        "report": evaluation.classification_report(scored, "target", "score", CUT),
        "areas": evaluation.curve_areas(curve),
        "roc_points": evaluation.roc_points(curve),
        "trees": model.nodes,
        "importance": model.importance(),
        "contributions": model.mean_contributions(test_rows),
    }
