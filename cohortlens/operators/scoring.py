"""Risk scores for the full history and the snapshot of one week."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.params import RunParams
from cohortlens.schemas import MODEL_FEATURES


@dataclass(frozen=True)
class LinearScorer:
    """A logistic score on standardised features, kept as plain numbers.

    The score is a column expression inside generated code: no vectors, no Python per row.
    A feature without variance (scale 0) contributes nothing.
    """

    features: Sequence[str]
    means: Sequence[float]
    scales: Sequence[float]
    coefficients: Sequence[float]
    intercept: float

    def standardised(self, feature: str) -> str:
        """SQL text of one standardised feature."""
        i = list(self.features).index(feature)
        if self.scales[i] == 0:
            return "0.0D"
        return f"((`{feature}` - ({float(self.means[i])!r}D)) / {float(self.scales[i])!r}D)"

    def margin(self) -> Column:
        terms = [f"({float(w)!r}D) * {self.standardised(f)}" for f, w in zip(self.features, self.coefficients)]
        return F.expr(" + ".join([f"({float(self.intercept)!r}D)", *terms]))

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))


def standard_moments(df: DataFrame, features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Row count, mean and population deviation of each feature, one row in one pass."""
    return df.agg(
        F.count("*").alias("n"),
        *[F.avg(c).alias(f"mean_{c}") for c in features],
        *[F.stddev_pop(c).alias(f"scale_{c}") for c in features],
    )


def standardise(df: DataFrame, features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Add ``z_<feature>`` by population deviation; no variance gives 0.

    The moments are one subquery of a single row within the same plan.
    """
    moments = standard_moments(df, features)
    row = moments.select(F.struct(*moments.columns).alias("moments")).scalar()

    def z(c: str) -> Column:
        mean, scale = F.col(f"_moments.mean_{c}"), F.col(f"_moments.scale_{c}")
        return F.when(scale != 0, (F.col(c) - mean) / scale).when(F.col(c).isNotNull(), F.lit(0.0))

    return df.withColumn("_moments", row).select(*df.columns, *[z(c).alias(f"z_{c}") for c in features])


def with_flag(df: DataFrame, threshold: float = RunParams.risk_threshold) -> DataFrame:
    return df.withColumn("high_risk_flag", (F.col("risk_score") >= F.lit(threshold)).cast("int"))


def score_linear(panel: DataFrame, scorer: LinearScorer, threshold: float = RunParams.risk_threshold) -> DataFrame:
    """Score every panel row; rows stay where they are (no shuffle)."""
    return with_flag(panel.withColumn("risk_score", scorer.probability()), threshold)


def score_foreign(
    panel: DataFrame,
    model: object,
    features: Sequence[str] = MODEL_FEATURES,
    threshold: float = RunParams.risk_threshold,
) -> DataFrame:
    """Score with any picklable object that has ``predict_proba(X)``, in Arrow batches.

    The object is shipped to each executor once. Models of this package need no such hook.
    """
    shipped = panel.sparkSession.sparkContext.broadcast(model)
    names = list(features)

    @F.pandas_udf("double")
    def probability(rows: pd.DataFrame) -> pd.Series:
        return pd.Series(np.asarray(shipped.value.predict_proba(rows[names]))[:, 1])

    return with_flag(panel.withColumn("risk_score", probability(F.struct(*names))), threshold)


def scored_order(scored: DataFrame) -> DataFrame:
    """Weeks ascending, risk descending within a week; ids break ties."""
    return scored.orderBy(F.col("week"), F.col("risk_score").desc(), "id_student", "code_module")


def risk_order() -> list[Column]:
    return [F.col("risk_score").desc(), F.col("id_student"), F.col("code_module")]


def snapshot(scored: DataFrame, current_week: int | None = None) -> DataFrame:
    """Rows of the wanted week if it has any, else of the last week."""
    week = F.col("week")
    last = F.max("week")
    if current_week is not None:
        last = F.coalesce(F.max(F.when(week == F.lit(current_week), week)), last)
    chosen = scored.agg(last.alias("week")).scalar()
    return scored.filter(week == chosen)


def top_k(snap: DataFrame, k: int = RunParams.top_k) -> DataFrame:
    """The k highest risks; each task keeps only k rows."""
    return snap.orderBy(*risk_order()).limit(k)
