"""Classifiers by name: ``pyspark.ml`` estimators, and the Newton fit and the boosted trees of this package."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators.boosting import BoostedTrees, Settings, fit_boosted
from cohortlens.operators.newton import fit_newton
from cohortlens.operators.scoring import LinearScorer, score_linear, standard_moments, with_flag
from cohortlens.params import RunParams
from cohortlens.schemas import MODEL_FEATURES, MODEL_LABEL
from cohortlens.session import checkpointed

INPUT = "features"
#: rows of a task from which on boosting deals them to more tasks
TASK_ROWS = 20_000


@dataclass
class TrainedModel:
    name: str
    pipeline: PipelineModel
    features: list[str]
    settings: dict
    moments: dict[str, float]

    def linear(self) -> LinearScorer:
        """The logistic model as plain numbers for scoring in generated code."""
        fitted = self.pipeline.stages[-1]
        return LinearScorer(
            self.features,
            [self.moments[f"mean_{c}"] for c in self.features],
            [self.moments[f"scale_{c}"] for c in self.features],
            [float(w) for w in fitted.coefficients],
            float(fitted.intercept),
        )

    def score(self, df: DataFrame, threshold: float = RunParams.risk_threshold) -> DataFrame:
        """Add ``risk_score`` and ``high_risk_flag`` to every row."""
        scored = self.pipeline.transform(df).withColumn("risk_score", vector_to_array("probability")[1])
        return with_flag(scored.select(*df.columns, "risk_score"), threshold)


def _standardiser(moments: dict[str, float], features: Sequence[str]) -> SQLTransformer:
    columns = []
    for c in features:
        mean, scale = moments[f"mean_{c}"], moments[f"scale_{c}"]
        z = f"(`{c}` - ({mean!r}D)) / {scale!r}D" if scale else "0.0D"
        columns.append(f"{z} AS `z_{c}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")


def _logistic(seed: int, rows: int, n_features: int) -> tuple[object, dict]:
    # penalty strength 1 on the summed loss is 1/rows on Spark's mean loss
    estimator = LogisticRegression(
        featuresCol=INPUT, maxIter=1000, regParam=1.0 / max(rows, 1), elasticNetParam=0.0, standardization=False, tol=1e-7
    )
    return estimator, {"model_type": "LogisticRegression", "max_iter": 1000, "random_seed": seed}


def _mlp(seed: int, rows: int, n_features: int, max_iter: int = 100) -> tuple[object, dict]:
    estimator = MultilayerPerceptronClassifier(featuresCol=INPUT, layers=[n_features, 32, 16, 2], maxIter=max_iter, seed=seed)
    return estimator, {"model_type": "MLPClassifier", "hidden_layers": [32, 16], "max_iter": max_iter, "random_seed": seed}


def _gbt(seed: int, rows: int, n_features: int, trees: int = 200) -> tuple[object, dict]:
    estimator = GBTClassifier(
        featuresCol=INPUT,
        maxIter=trees,
        maxDepth=6,
        stepSize=0.1,
        subsamplingRate=0.8,
        featureSubsetStrategy="0.8",
        maxMemoryInMB=1024,
        checkpointInterval=20,
        seed=seed,
    )
    settings = {"model_type": "GBTClassifier", "trees": trees, "max_depth": 6, "step_size": 0.1, "random_seed": seed}
    return estimator, settings


MODELS: dict[str, Callable] = {"logistic": _logistic, "mlp": _mlp, "gbt": _gbt}
STANDARDISED = ("logistic", "mlp")


def train(
    df: DataFrame,
    name: str = "logistic",
    features: Sequence[str] = MODEL_FEATURES,
    label: str = MODEL_LABEL,
    seed: int = RunParams.seed,
    **options,
) -> TrainedModel:
    """Fit the named model on the rows of ``df``; an unknown name is an error.

    Only the moments (one row) and the fitted model come to the driver. Every training pass
    reads the rows, so they are checkpointed once, in as many partitions as their size asks for; for boosting, whose
    passes (one a level and tree) are work, not reading, in one per ``TASK_ROWS`` up to the session's parallelism.
    """
    if name not in MODELS:
        raise ValueError(f"unknown model {name!r}, choose one of {sorted(MODELS)}")
    features = list(features)
    rows = checkpointed(df.select(*features, F.col(label).cast("double").alias("_label")))
    row = standard_moments(rows, features).first().asDict()
    if name == "gbt":
        tasks = min(rows.sparkSession.sparkContext.defaultParallelism, -(-row["n"] // TASK_ROWS))
        if tasks > rows.rdd.getNumPartitions():
            rows = checkpointed(rows.repartition(tasks))
    estimator, settings = MODELS[name](seed, row["n"], len(features), **options)
    estimator.setLabelCol("_label")
    if name in STANDARDISED:
        stages = [_standardiser(row, features), VectorAssembler(inputCols=[f"z_{c}" for c in features], outputCol=INPUT)]
    else:
        stages = [VectorAssembler(inputCols=features, outputCol=INPUT)]
    pipeline = Pipeline(stages=[*stages, estimator]).fit(rows)
    return TrainedModel(name, pipeline, features, settings, row)


@dataclass
class NewtonModel:
    """The logistic score fitted by Newton's method."""

    scorer: LinearScorer
    features: list[str]
    settings: dict
    name: str = "newton"

    def linear(self) -> LinearScorer:
        return self.scorer

    def score(self, df: DataFrame, threshold: float = RunParams.risk_threshold) -> DataFrame:
        return score_linear(df, self.scorer, threshold)

    def save(self, spark: SparkSession, path: str) -> None:
        coefficient_rows(spark, self.scorer).coalesce(1).write.mode("overwrite").parquet(path)


@dataclass
class TreeModel:
    """Boosted trees as a table of nodes."""

    trees: BoostedTrees
    features: list[str]
    settings: dict
    name: str = "boosted"

    def score(self, df: DataFrame, threshold: float = RunParams.risk_threshold) -> DataFrame:
        return self.trees.score(df, threshold).drop("margin")

    def save(self, spark: SparkSession, path: str) -> None:
        self.trees.nodes.coalesce(1).write.mode("overwrite").parquet(path)


OWN_MODELS = ("newton", "boosted")


def train_named(df: DataFrame, name: str, keys: Sequence[str], features: Sequence[str] = MODEL_FEATURES, label: str = MODEL_LABEL, seed: int = RunParams.seed, **options):
    """Fit a model by name: one of ``OWN_MODELS`` or one of the library's (``train``). ``keys`` name the unique key of the rows."""
    features = list(features)
    if name == "newton":
        return NewtonModel(fit_newton(df, features, label, **options), features, {"model_type": "LogisticRegression", "solver": "newton", "random_seed": seed})
    if name == "boosted":
        settings = Settings(seed=seed, **options)
        shown = {"model_type": "BoostedTrees", "trees": settings.trees, "max_depth": settings.depth, "step_size": settings.rate, "random_seed": seed}
        return TreeModel(fit_boosted(df, features, label, keys, settings), features, shown)
    if name not in MODELS:
        raise ValueError(f"unknown model {name!r}, choose one of {sorted([*MODELS, *OWN_MODELS])}")
    return train(df, name, features, label, seed, **options)


def model_metadata(
    spark: SparkSession, model: TrainedModel, split_week: int, train_rows: int, test_rows: int, seed: int
) -> DataFrame:
    row = (model.name, model.features, seed, split_week, train_rows, test_rows, {k: str(v) for k, v in model.settings.items()})
    return spark.createDataFrame(
        [row],
        "model_backend string, feature_columns array<string>, random_seed int, split_week int, "
        "train_rows long, test_rows long, backend_hyperparams map<string,string>",
    )


def save_model(model: TrainedModel | NewtonModel | TreeModel, path: str) -> None:
    if isinstance(model, (NewtonModel, TreeModel)):
        model.save(SparkSession.active(), path)
        return
    model.pipeline.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def coefficient_rows(spark: SparkSession, scorer: LinearScorer) -> DataFrame:
    """Coefficients as rows (one per feature and one for the intercept)."""
    rows = [("intercept", float(scorer.intercept)), *[(f, float(w)) for f, w in zip(scorer.features, scorer.coefficients)]]
    return spark.createDataFrame(rows, "feature string, coefficient double")


def tree_importance(spark: SparkSession, model: TrainedModel) -> DataFrame:
    """Importance per feature of a tree model, with its true rank (1 = most important)."""
    weights = model.pipeline.stages[-1].featureImportances.toArray()
    ordered = sorted(zip(model.features, (float(w) for w in weights)), key=lambda x: (-x[1], x[0]))
    rows = [(feature, weight, i + 1) for i, (feature, weight) in enumerate(ordered)]
    return spark.createDataFrame(rows, "feature string, importance double, rank int")


def side_rows(split: DataFrame) -> DataFrame:
    """Row count per side of a split."""
    return split.groupBy("side").agg(F.count("*").alias("rows"))
