"""Logistic regression by Newton's method, one aggregate of the whole table per step.

A step needs the gradient and the weighted Gram matrix of the standardised features: for k features (k + 1)(k + 4) / 2 + 1 sums,
taken as columns of one aggregate with partial sums in every task. One row reaches the driver, which solves
a system of k + 1 unknowns. The loss comes with the same pass; a step that raised it is halved.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.scoring import LinearScorer, standard_moments
from cohortlens.schemas import MODEL_FEATURES, MODEL_LABEL
from cohortlens.session import checkpointed

STEPS, TOLERANCE, RIDGE = 50, 1e-11, 1.0


def _pass(rows: DataFrame, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and Gram matrix at ``weights`` (the last is the intercept), without the penalty."""
    k = len(weights)
    z = [F.col(f"z{i}") for i in range(k - 1)] + [F.lit(1.0)]
    margin = sum((F.lit(float(w)) * c for w, c in zip(weights, z, strict=True)), F.lit(0.0))
    at = rows.withColumn("m", margin).withColumn("p", 1.0 / (1.0 + F.exp(-F.col("m")))).withColumn("w", F.col("p") * (1.0 - F.col("p")))
    # log(1 + exp(m)) - y m, written so that no exponent overflows
    loss = F.greatest("m", F.lit(0.0)) + F.log1p(F.exp(-F.abs("m"))) - F.col("y") * F.col("m")
    sums: list[Column] = [F.sum(loss).alias("loss")]
    sums += [F.sum((F.col("p") - F.col("y")) * z[i]).alias(f"g{i}") for i in range(k)]
    sums += [F.sum(F.col("w") * z[i] * z[j]).alias(f"h{i}_{j}") for i in range(k) for j in range(i + 1)]
    row = at.agg(*sums).first()
    gram = np.zeros((k, k))
    for i in range(k):
        for j in range(i + 1):
            gram[i, j] = gram[j, i] = row[f"h{i}_{j}"]
    return row["loss"], np.array([row[f"g{i}"] for i in range(k)]), gram


def fit_newton(
    df: DataFrame,
    features: Sequence[str] = MODEL_FEATURES,
    label: str = MODEL_LABEL,
    ridge: float = RIDGE,
    steps: int = STEPS,
    tolerance: float = TOLERANCE,
) -> LinearScorer:
    """Coefficients that minimise the summed log loss plus ``ridge / 2`` times their squares; the intercept is free.

    Features without variance get 0. Rows with a null in a feature or the label are left out.
    """
    features = list(features)
    known = df.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias("y")).na.drop()
    known = checkpointed(known)
    moments = standard_moments(known, features).first().asDict()
    if not moments["n"]:
        raise ValueError("no rows to fit")
    means, scales = ([moments[f"{kind}_{f}"] for f in features] for kind in ("mean", "scale"))
    z = [(F.col(f) - F.lit(m)) / F.lit(s) if s else F.lit(0.0) for f, m, s in zip(features, means, scales, strict=True)]
    rows = known.select(*[c.alias(f"z{i}") for i, c in enumerate(z)], "y")
    penalty = np.diag([ridge] * len(features) + [0.0])
    # a column of zeros has no curvature of its own without a penalty
    fixed = np.diag([0.0 if s or ridge else 1.0 for s in scales] + [0.0])
    weights, step, last = np.zeros(len(features) + 1), np.zeros(len(features) + 1), np.inf
    for _ in range(steps):
        loss, gradient, gram = _pass(rows, weights)
        loss += weights @ penalty @ weights / 2
        if loss > last * (1 + 1e-12) + 1e-12 and np.abs(step).max() > tolerance:
            step = step / 2
            weights = weights + step
            continue
        last = loss
        step = np.linalg.solve(gram + penalty + fixed, gradient + penalty @ weights)
        weights = weights - step
        if np.abs(step).max() < tolerance:
            break
    return LinearScorer(features, means, scales, [float(w) for w in weights[:-1]], float(weights[-1]))
