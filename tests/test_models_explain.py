from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import explain, models, scoring
from cohortlens.operators.scoring import LinearScorer

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 2)) * [2.0, 5.0] + [1.0, -3.0]
    y = (rng.random(300) < 1 / (1 + np.exp(-(1.2 * x[:, 0] - 0.3 * x[:, 1])))).astype(int)
    df = spark.createDataFrame(
        [(i, float(a), float(b), 4.0, int(t)) for i, ((a, b), t) in enumerate(zip(x, y))], "k long, a double, b double, c double, y int"
    ).cache()
    return df, x, y


def newton(x, y, steps=50):
    """Penalised logistic regression (strength 1, free intercept) on standardised columns."""
    z = np.column_stack([(x - x.mean(0)) / x.std(0), np.ones(len(x))])
    w, ridge = np.zeros(z.shape[1]), np.diag([1.0] * x.shape[1] + [0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-z @ w))
        w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (p - y) + ridge @ w)
    return w


def test_logistic_matches_a_newton_solve(spark, data):
    df, x, y = data
    scorer = models.train(df, "logistic", FEATURES, "y").linear()
    want = newton(x, y)
    assert scorer.coefficients[:2] == pytest.approx(want[:2], abs=1e-4)
    assert scorer.intercept == pytest.approx(want[2], abs=1e-4)
    assert scorer.coefficients[2] == 0.0 and scorer.scales[2] == 0.0


def test_linear_scorer_equals_the_pipeline_and_survives_saving(spark, data, tmp_path):
    df, _, _ = data
    model = models.train(df, "logistic", FEATURES, "y")
    models.save_model(model, str(tmp_path / "m"))
    again = models.TrainedModel(model.name, models.load_pipeline(str(tmp_path / "m")), model.features, model.settings, model.moments)
    both = again.score(df).withColumn("linear", model.linear().probability())
    assert both.filter(F.abs(F.col("linear") - F.col("risk_score")) > 1e-12).count() == 0


@pytest.mark.parametrize("name, options", [("mlp", {"max_iter": 30}), ("gbt", {"trees": 5})])
def test_other_models_learn(spark, data, name, options):
    df, _, _ = data
    model = models.train(df, name, FEATURES, "y", **options)
    right = model.score(df).filter((F.col("risk_score") >= 0.5).cast("int") == F.col("y")).count()
    assert right > 220
    if name == "gbt":
        got = models.tree_importance(spark, model).collect()
        assert [r.rank for r in got] == [1, 2, 3] and got[0].importance >= got[1].importance and got[2].feature == "c"


def test_unknown_model(data):
    with pytest.raises(ValueError, match="unknown model"):
        models.train(data[0], "oracle", FEATURES, "y")


def test_permutation_importance(spark, data):
    df, _, _ = data
    scorer = LinearScorer(FEATURES, [0.0] * 3, [1.0] * 3, [1.2, -0.3, 0.0], 0.0)
    got = {r.feature: r.importance for r in explain.permutation_importance(df, scorer, "y", ["k"], repeats=4).collect()}
    assert got["a"] > got["b"] > 0.005 and got["c"] == pytest.approx(0.0, abs=1e-12)
    again = {r.feature: r.importance for r in explain.permutation_importance(df.repartition(7), scorer, "y", ["k"], repeats=4).collect()}
    assert again == pytest.approx(got)


def test_linear_contributions(spark, data):
    df, x, _ = data
    scorer = LinearScorer(FEATURES, [1.0, -3.0, 4.0], [2.0, 5.0, 0.0], [1.5, -0.5, 2.0], 0.1)
    got = {r.feature: r.mean_abs_contribution for r in explain.linear_contributions(df, scorer).collect()}
    assert got["a"] == pytest.approx(np.abs(1.5 * (x[:, 0] - x[:, 0].mean()) / 2.0).mean())
    assert got["b"] == pytest.approx(np.abs(0.5 * (x[:, 1] - x[:, 1].mean()) / 5.0).mean())
    assert got["c"] == 0.0
    top = explain.top_features(explain.linear_contributions(df, scorer), "mean_abs_contribution", 2)
    assert [r.feature for r in top.collect()] == ["a", "b"]
    assert set(explain.feature_map(top, "mean_abs_contribution").first()[0]) == {"a", "b"}


def test_standardise_agrees_with_the_training_moments(spark, data):
    df, x, _ = data
    row = scoring.standard_moments(df, FEATURES).first()
    assert row.scale_a == pytest.approx(x[:, 0].std()) and row.n == 300


def test_boosting_deals_its_rows_to_more_tasks(spark, data, monkeypatch):
    df, _, _ = data
    seen = []
    monkeypatch.setattr(models, "TASK_ROWS", 100)
    monkeypatch.setattr(models.Pipeline, "fit", lambda self, rows: seen.append(rows) or None)
    models.train(df.coalesce(1), "gbt", FEATURES, "y", trees=2)
    models.train(df.coalesce(1), "logistic", FEATURES, "y")
    assert [r.rdd.getNumPartitions() for r in seen] == [3, 1] and seen[0].count() == 300
