"""Which features drive the score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.columns import uniform
from cohortlens.functions.ordered import shuffled_ranks
from cohortlens.operators.evaluation import curve_areas, score_curve
from cohortlens.operators.models import TrainedModel
from cohortlens.operators.scoring import LinearScorer
from cohortlens.params import RunParams
from cohortlens.session import materialise


def linear_contributions(df: DataFrame, scorer: LinearScorer) -> DataFrame:
    """Mean absolute contribution of each feature to the margin, against the mean row of ``df``.

    The contribution of a feature is its coefficient times the distance from its mean, both
    standardised. Two light passes: the means as a one-row subquery, then one aggregate.
    """
    used = list(scorer.features)
    z = {c: F.expr(scorer.standardised(c)) for c in used}
    means = df.agg(*[F.avg(z[c]).alias(c) for c in used]).select(F.struct(*used).alias("means")).scalar()
    centred = df.select(*used).withColumn("_means", means)
    weights = dict(zip(used, scorer.coefficients))
    row = centred.agg(
        *[F.avg(F.abs(F.lit(float(weights[c])) * (z[c] - F.col(f"_means.{c}")))).alias(c) for c in used]
    )
    return as_rows(row, used, "feature", "mean_abs_contribution")


def as_rows(row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per column of a one-row frame."""
    entries = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in columns])
    return row.select(F.explode(entries).alias("entry")).select("entry.*")


def top_features(importance: DataFrame, value: str, n: int = 10) -> DataFrame:
    return importance.orderBy(F.col(value).desc(), "feature").limit(n)


def feature_map(importance: DataFrame, value: str) -> DataFrame:
    """A short feature table as one map; its size is the number of features."""
    entries = F.sort_array(F.collect_list(F.struct("feature", value)))
    return importance.agg(F.map_from_entries(entries).alias("top_features"))


def permutation_importance(
    df: DataFrame,
    model: TrainedModel | LinearScorer,
    label: str,
    keys: Sequence[str],
    repeats: int = 10,
    seed: int = RunParams.seed,
) -> DataFrame:
    """Mean loss of ROC-AUC when one feature is shuffled across rows.

    Rows are placed once in a seeded random order. In repeat r the shuffled value of a row is
    that of the row a random distance further on in this order, so one equi-join per repeat
    serves all features. All repeats and features run in the same pass, told apart by columns.
    """
    features = list(model.features)
    ranked = materialise(
        shuffled_ranks(df.select(*dict.fromkeys([*keys, *features, label])), keys, seed), "ranked"
    )
    receivers = ranked.select("_rank", "_rows", *features, label).withColumn(
        "rep", F.explode(F.sequence(F.lit(1), F.lit(repeats)))
    )
    step = F.lit(1) + F.floor(uniform(seed, F.col("rep")) * F.greatest(F.col("_rows") - 1, F.lit(1)))
    aimed = receivers.withColumn("_donor", F.pmod(F.col("_rank") + step, F.col("_rows")))
    donors = ranked.select(F.col("_rank").alias("_donor"), *[F.col(c).alias(f"other_{c}") for c in features])
    pairs = aimed.join(donors, "_donor")
    variants = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("feature"),
                    *[F.col(f"other_{f}" if f == c else f).cast("double").alias(f) for f in features],
                )
                for c in features
            ]
        )
    )
    shuffled = pairs.select("rep", label, variants.alias("variant")).select("rep", label, "variant.*")
    base = ranked.select(F.lit(0).alias("rep"), F.lit("").alias("feature"), label, *[F.col(f).cast("double").alias(f) for f in features])
    scored = _score(base.unionByName(shuffled), model)
    areas = curve_areas(score_curve(scored, label, "risk_score", ["rep", "feature"]), ["rep", "feature"])
    # repeats x features + 1 rows from here on
    areas = materialise(areas, "permutation-areas")
    baseline = areas.filter(F.col("rep") == 0).agg(F.max("auc").alias("auc")).scalar()
    return areas.filter(F.col("rep") > 0).groupBy("feature").agg(
        F.avg(baseline - F.col("auc")).alias("importance"), F.stddev_pop(baseline - F.col("auc")).alias("importance_std")
    )


def _score(df: DataFrame, model: TrainedModel | LinearScorer) -> DataFrame:
    if isinstance(model, LinearScorer):
        return df.withColumn("risk_score", model.probability())
    if model.name == "logistic":
        return df.withColumn("risk_score", model.linear().probability())
    return model.score(df)
