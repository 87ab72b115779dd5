from __future__ import annotations

import numpy as np
import pytest

from cohortlens.operators import evaluation


def frame(spark, labels, scores):
    return spark.createDataFrame([(int(y), float(s)) for y, s in zip(labels, scores)], "y int, s double")


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))


def brute_pr(y, s):
    points = [(0.0, 1.0)]
    for cut in np.unique(s)[::-1]:
        taken = s >= cut
        points.append((y[taken].sum() / y.sum(), y[taken].mean()))
    return sum((r1 - r0) * (p1 + p0) / 2 for (r0, p0), (r1, p1) in zip(points, points[1:]))


@pytest.mark.parametrize("seed, digits", [(0, 8), (1, 1), (2, 2)])
def test_areas_match_brute_force(spark, seed, digits):
    rng = np.random.default_rng(seed)
    y = (rng.random(800) < 0.4).astype(int)
    s = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), digits)
    row = evaluation.curve_areas(evaluation.score_curve(frame(spark, y, s), "y", "s")).first()
    assert row.auc == pytest.approx(brute_auc(y, s), abs=1e-12)
    assert row.pr_auc == pytest.approx(brute_pr(y, s), abs=1e-12)


def test_pr_curve_is_anchored_when_the_top_score_ties(spark):
    y, s = np.array([1, 0, 1, 0]), np.array([0.9, 0.9, 0.5, 0.1])
    row = evaluation.curve_areas(evaluation.score_curve(frame(spark, y, s), "y", "s")).first()
    assert row.pr_auc == pytest.approx(brute_pr(y, s))
    assert row.pr_auc != pytest.approx(0.5 * 0.5 + 0.5 * (0.5 + 2 / 3) / 2)


def test_areas_by_group(spark):
    rng = np.random.default_rng(5)
    y, s, g = (rng.random(600) < 0.5).astype(int), np.round(rng.random(600), 2), rng.integers(0, 3, 600)
    df = spark.createDataFrame([(int(a), int(b), float(c)) for a, b, c in zip(g, y, s)], "g int, y int, s double")
    got = {r.g: r.auc for r in evaluation.curve_areas(evaluation.score_curve(df, "y", "s", ["g"]), ["g"]).collect()}
    for k in range(3):
        assert got[k] == pytest.approx(brute_auc(y[g == k], s[g == k]), abs=1e-12)


def test_one_class_only_gives_null(spark):
    row = evaluation.curve_areas(evaluation.score_curve(frame(spark, [1, 1], [0.2, 0.4]), "y", "s")).first()
    assert row.auc is None and row.pr_auc == pytest.approx(1.0)


def test_published_confusion_matrix_gives_published_rates(spark):
    cells = [(0, 0.1, 479), (0, 0.9, 20), (1, 0.1, 37), (1, 0.9, 664)]
    df = spark.createDataFrame([(y, s) for y, s, n in cells for _ in range(n)], "y int, s double")
    assert evaluation.confusion_matrix(df, "y", "s").first()[0] == [[479, 20], [37, 664]]
    row = evaluation.precision_recall(df, "y", "s").first()
    assert row.precision_at_cut == pytest.approx(0.97076, abs=1e-5)
    assert row.recall_at_cut == pytest.approx(0.94722, abs=1e-5)
    report = {r["class"]: r for r in evaluation.classification_report(df, "y", "s").collect()}
    assert report["1"].support == 701 and report["accuracy"].f1 == pytest.approx(1143 / 1200)
    assert report["macro avg"].recall == pytest.approx((479 / 499 + 664 / 701) / 2)


def test_no_predicted_positive(spark):
    row = evaluation.precision_recall(frame(spark, [1, 0], [0.1, 0.2]), "y", "s").first()
    assert row.precision_at_cut == 0.0 and row.recall_at_cut == 0.0
