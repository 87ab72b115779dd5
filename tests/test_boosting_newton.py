"""Newton's method and boosted trees against plain versions, with nulls, constant columns and ties."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import boosting, models, newton
from cohortlens.operators.boosting import BoostedTrees, Settings

FEATURES = ["a", "b", "c", "d"]
SCHEMA = "k long, a double, b double, c double, d double, y int"


@pytest.fixture(scope="module")
def table(spark):
    """300 rows: a tells most, b is null at times and says something by that, c is constant, d has three values."""
    rng = np.random.default_rng(7)
    rows = []
    for k in range(300):
        a, b, d = float(rng.normal(1, 2)), float(rng.normal(-3, 5)), float(rng.integers(0, 3))
        hidden = rng.random() < 0.2
        p = 1 / (1 + math.exp(-(1.1 * a - 0.2 * b + 0.5 * d + (2 if hidden else 0))))
        rows.append((k, a, None if hidden else b, 4.0, d, int(rng.random() < p)))
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


def test_newton_agrees_with_a_plain_solve_and_with_the_estimator(table):
    rows, df = table
    known = df.na.drop()
    scorer = newton.fit_newton(df, FEATURES, "y")
    x = np.array([r[1:5] for r in rows if r[2] is not None])
    y = np.array([r[5] for r in rows if r[2] is not None])
    scale = x.std(0)
    z = np.column_stack([np.where(scale > 0, (x - x.mean(0)) / np.where(scale > 0, scale, 1), 0.0), np.ones(len(x))])
    w, ridge = np.zeros(5), np.diag([1.0] * 4 + [0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ w))
        w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (p - y) + ridge @ w)
    assert [*scorer.coefficients, scorer.intercept] == pytest.approx(w.tolist(), abs=1e-9)
    assert scorer.coefficients[2] == 0.0
    estimator = models.train(known, "logistic", FEATURES, "y").linear()
    assert [*scorer.coefficients, scorer.intercept] == pytest.approx([*estimator.coefficients, estimator.intercept], abs=1e-4)


def test_newton_where_a_full_step_overshoots(spark):
    """Two values far out and almost separable: halved steps keep the loss falling."""
    rows = [(float(x), int(y)) for x, y in [(-100, 0), (-1, 0), (0, 1), (1, 0), (2, 1), (200, 1)] * 3]
    df = spark.createDataFrame(rows, "a double, y int")
    scorer = newton.fit_newton(df, ["a"], "y", ridge=1e-3)
    at = newton._pass(df.select(((F.col("a") - scorer.means[0]) / scorer.scales[0]).alias("z0"), "y"), np.array([*scorer.coefficients, scorer.intercept]))
    assert at[1] + np.array([1e-3 * scorer.coefficients[0], 0.0]) == pytest.approx([0, 0], abs=1e-8)
    with pytest.raises(ValueError, match="no rows"):
        newton.fit_newton(df.limit(0), ["a"], "y")


def plain_boosting(rows, settings, names=FEATURES):
    """Trees as lists of (node, feature, threshold, nulls_left, gain, cover, value), and the margins."""

    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    limits = []
    for f in range(len(names)):
        known = np.array([r[1 + f] for r in rows if r[1 + f] is not None])
        limits.append(sorted({float(np.quantile(known, i / settings.bins)) for i in range(1, settings.bins)}))
    margins, trees = {r[0]: settings.base_margin for r in rows}, []
    for tree in range(1, settings.trees + 1):
        columns = boosting.columns_of(tree, names, settings.column_share, settings.seed)
        drawn = [r for r in rows if int(md5(md5(f"{r[0]}|{settings.seed}") + f"|{tree}")[:8], 16) / 2**32 < settings.row_share]
        p = {r[0]: 1 / (1 + math.exp(-margins[r[0]])) for r in rows}
        nodes = []

        def part(members):
            g, h = sum(p[r[0]] - r[5] for r in members), sum(p[r[0]] * (1 - p[r[0]]) for r in members)
            return g, h, g * g / (h + settings.leaf_penalty)

        def left_of(r, f, t, nulls_left):
            return nulls_left if r[1 + f] is None else r[1 + f] < t

        def grow(number, members, everyone, level):
            g, h, whole = part(members)
            best = None
            if level < settings.depth:
                for f in columns:
                    for t in limits[f]:
                        for nulls_left in (False, True):
                            sides = [[r for r in members if left_of(r, f, t, nulls_left) == side] for side in (True, False)]
                            known = [[r for r in s if r[1 + f] is not None] for s in sides]
                            if not known[0] or not known[1] or (nulls_left and all(r[1 + f] is not None for r in members)):
                                continue
                            (_, hl, x), (_, hr, z) = part(sides[0]), part(sides[1])
                            gain = x + z - whole
                            # the threshold is the lowest that has the same sides
                            if min(hl, hr) >= settings.least_hessian and gain > 1e-6 and (best is None or round(gain, 9) > round(best[0], 9)):
                                best = (gain, f, t, nulls_left)
            value = -settings.rate * g / (h + settings.leaf_penalty)
            if best is None:
                nodes.append((number, None, None, None, None, h, value))
                for r in everyone:
                    margins[r[0]] += value
                return
            gain, f, t, nulls_left = best
            nodes.append((number, names[f], t, nulls_left, gain, h, value))
            for side in (True, False):
                grow(2 * number + (not side), [r for r in members if left_of(r, f, t, nulls_left) == side], [r for r in everyone if left_of(r, f, t, nulls_left) == side], level + 1)

        grow(1, drawn, rows, 0)
        trees.append(sorted(nodes))
    return trees, margins


@pytest.fixture(scope="module")
def fitted(table):
    settings = Settings(trees=4, depth=3, bins=12, rate=0.3, column_share=0.75)
    return settings, boosting.fit_boosted(table[1], FEATURES, "y", ["k"], settings)


def test_trees_against_plain_boosting(table, fitted):
    settings, model = fitted
    want, margins = plain_boosting(table[0], settings)
    got = [[] for _ in want]
    for r in model.nodes.collect():
        got[r.tree - 1].append((r.node, r.feature, r.threshold, r.nulls_left, r.gain, r.cover, r.value))
    for a, b in zip(got, want, strict=True):
        assert [x[:2] for x in sorted(a)] == [x[:2] for x in b]
        for x, y in zip(sorted(a), b, strict=True):
            # a threshold between two values of the node parts it alike, so sides are compared by their sums
            assert (x[3], x[4], x[5], x[6]) == (y[3], y[4] if y[4] is None else pytest.approx(y[4]), pytest.approx(y[5]), pytest.approx(y[6]))
    scored = {r.k: r.margin for r in model.score(table[1]).collect()}
    assert scored == pytest.approx(margins, abs=1e-9)
    assert any(x[3] for t in want for x in t), "no split sends nulls to the left"


def test_contributions_add_up_to_the_margin(table, fitted):
    _, model = fitted
    both = model.contributions(model.score(table[1])).collect()
    assert all(abs(r.base + sum(r.contributions.values()) - r.margin) < 1e-9 for r in both)
    assert all(r.contributions["c"] == 0.0 for r in both) and any(r.contributions["a"] for r in both)
    mean = {r.feature: r.mean_abs_contribution for r in model.mean_contributions(table[1]).collect()}
    assert mean["a"] == pytest.approx(np.mean([abs(r.contributions["a"]) for r in both]))
    assert mean["a"] == max(mean.values())


def test_importance_has_shares_and_ranks(fitted):
    got = {r.feature: r for r in fitted[1].importance().collect()}
    assert sum(r.importance for r in got.values()) == pytest.approx(1.0)
    order = sorted(got.values(), key=lambda r: (-r.importance, r.feature))
    assert [r["rank"] for r in order] == [1, 2, 3, 4] and got["c"].splits == 0 and order[0].feature == "a"


def test_trees_learn_and_repeat(spark, table):
    settings = Settings(trees=12, depth=4, bins=16, rate=0.3)
    model = boosting.fit_boosted(table[1], FEATURES, "y", ["k"], settings)
    again = boosting.fit_boosted(table[1].repartition(2), FEATURES, "y", ["k"], settings)
    a, b = ([tuple(r)[:5] for r in m.nodes.orderBy("tree", "node").collect()] for m in (model, again))
    assert a == b
    right = model.score(table[1]).where((F.col("risk_score") >= 0.5).cast("int") == F.col("y")).count()
    assert right > 240
    one = BoostedTrees(spark.createDataFrame([(1, 1, None, None, None, None, 3.0, 0.25)], boosting.NODES), FEATURES, settings)
    assert {r.margin for r in one.score(table[1]).collect()} == {0.25}
    assert boosting.fit_boosted(table[1].limit(0), FEATURES, "y", ["k"], settings).nodes.count() == 0
