"""Model quality from a scored table with a 0/1 label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.ordered import running_sums


def confusion_counts(scored: DataFrame, label: str, score: str, cut: float = 0.5) -> DataFrame:
    """tn, fp, fn, tp at a cut, one row in one pass."""
    positive = F.col(score) >= F.lit(cut)

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")

    return scored.agg(
        rows((F.col(label) == 0) & ~positive).alias("tn"),
        rows((F.col(label) == 0) & positive).alias("fp"),
        rows((F.col(label) == 1) & ~positive).alias("fn"),
        rows((F.col(label) == 1) & positive).alias("tp"),
    )


def confusion_matrix(scored: DataFrame, label: str, score: str, cut: float = 0.5) -> DataFrame:
    """Rows are actual classes, columns predicted ones, as one nested array."""
    return confusion_counts(scored, label, score, cut).select(
        F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("confusion_matrix")
    )


def precision_recall(scored: DataFrame, label: str, score: str, cut: float = 0.5) -> DataFrame:
    """Precision and recall at a cut; an empty denominator counts as 1."""
    return confusion_counts(scored, label, score, cut).select(
        (F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1))).alias("precision_at_cut"),
        (F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), F.lit(1))).alias("recall_at_cut"),
    )


def classification_report(scored: DataFrame, label: str, score: str, cut: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class, their averages, and accuracy."""
    c = confusion_counts(scored, label, score, cut)

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    def entry(name: str, hit: str, false_hit: str, missed: str) -> Column:
        precision = ratio(F.col(hit), F.col(hit) + F.col(false_hit))
        recall = ratio(F.col(hit), F.col(hit) + F.col(missed))
        f1 = ratio(2 * F.col(hit), 2 * F.col(hit) + F.col(false_hit) + F.col(missed))
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            (F.col(hit) + F.col(missed)).alias("support"),
        )

    both = c.select(
        entry("0", "tn", "fn", "fp").alias("a"),
        entry("1", "tp", "fp", "fn").alias("b"),
        ratio(F.col("tn") + F.col("tp"), F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("accuracy"),
    )
    total = F.col("a.support") + F.col("b.support")

    def average(name: str, weight_a: Column, weight_b: Column) -> Column:
        def mean(field: str) -> Column:
            return ratio(F.col(f"a.{field}") * weight_a + F.col(f"b.{field}") * weight_b, weight_a + weight_b)

        return F.struct(
            F.lit(name).alias("class"),
            mean("precision").alias("precision"),
            mean("recall").alias("recall"),
            mean("f1").alias("f1"),
            total.alias("support"),
        )

    accuracy = F.struct(
        F.lit("accuracy").alias("class"),
        F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"),
        F.col("accuracy").alias("f1"),
        total.alias("support"),
    )
    lines = F.array(
        F.col("a"),
        F.col("b"),
        accuracy,
        average("macro avg", F.lit(1.0), F.lit(1.0)),
        average("weighted avg", F.col("a.support").cast("double"), F.col("b.support").cast("double")),
    )
    return both.select(F.explode(lines).alias("line")).select("line.*")


def score_curve(scored: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score with running positives and negatives from the top."""
    known = scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = known.groupBy(*by, F.col(score).alias("threshold")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).alias("neg"),
    )
    return running_sums(counts, "threshold", ["pos", "neg"], by, descending=True)


def roc_points(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """False and true positive rate at every distinct score, plus the origin (null threshold)."""
    point = F.struct(
        F.col("threshold").cast("double").alias("threshold"),
        F.try_divide("cum_neg", "total_neg").alias("fpr"),
        F.try_divide("cum_pos", "total_pos").alias("tpr"),
    )
    origin = F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    # the top score of a group, whose running counts are its own, also yields the origin
    is_top = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    points = F.when(is_top, F.array(origin, point)).otherwise(F.array(point))
    return curve.select(*by, F.explode(points).alias("point")).select(*by, "point.*")


def curve_areas(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC and the precision-recall curve; ties share a score, so they are exact.

    The precision-recall curve starts at recall 0 with precision 1.
    """
    before_pos = F.col("cum_pos") - F.col("pos")
    before_all = before_pos + F.col("cum_neg") - F.col("neg")
    roc = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2))
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    precision_before = F.when(before_all == 0, F.lit(1.0)).otherwise(F.try_divide(before_pos, before_all))
    pr = F.sum(F.col("pos") * (precision + precision_before) / 2)
    return curve.groupBy(*by).agg(
        F.try_divide(roc, F.max(F.col("total_pos") * F.col("total_neg").cast("double"))).alias("auc"),
        F.try_divide(pr, F.max("total_pos")).alias("pr_auc"),
    )


def metric_row(scored: DataFrame, label: str, score: str, model_name: str, cut: float = 0.5) -> DataFrame:
    """All metrics of one evaluated table as one row."""
    counts = confusion_counts(scored, label, score, cut)
    matrix = F.array(F.array("tn", "fp"), F.array("fn", "tp"))
    areas = curve_areas(score_curve(scored, label, score)).select(F.struct("auc", "pr_auc").alias("areas"))
    return counts.withColumn("areas", areas.scalar()).select(
        F.col("areas.auc").alias("auc"),
        F.col("areas.pr_auc").alias("pr_auc"),
        (F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1))).alias("precision_at_0_5"),
        (F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), F.lit(1))).alias("recall_at_0_5"),
        matrix.alias("confusion_matrix"),
        F.lit(model_name).alias("model_backend"),
    )
