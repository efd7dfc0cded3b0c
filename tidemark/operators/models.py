"""Classifiers: training, search, storage, scoring, importance."""

from __future__ import annotations

import logging
import math
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    Evaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession

from tidemark.defaults import FOLDS, SEED
from tidemark.functions import hash_bucket, named
from tidemark.operators.features import FEATURES, RAW
from tidemark.sources.storage import ensure_checkpoint_dir

logger = logging.getLogger(__name__)

BINARY_METRICS = ("areaUnderROC", "areaUnderPR")

# Naive Bayes is Gaussian because scaled features are negative as well.
ALGORITHMS = {
    "gbt": GBTClassifier,
    "rfc": RandomForestClassifier,
    "dtc": DecisionTreeClassifier,
    "lr": LogisticRegression,
    "svc": LinearSVC,
    "nb": lambda: NaiveBayes(modelType="gaussian"),
}


#: A task of a fit gets about so many entries of vectors, 40 MB.
TASK_ENTRIES = 2_000_000


def spread(rows: DataFrame, entries: int = TASK_ENTRIES) -> DataFrame:
    """The rows dealt evenly to as many tasks as their vectors need; few rows stay where they are.

    Files hold vectors' inputs far smaller than vectors, so one file's task may get all rows
    of a fit. The first row stands for the number of entries in each.
    """
    first = rows.select(FEATURES).first()
    if first is None or first[0] is None:
        return rows
    tasks = math.ceil(rows.count() * max(1, len(first[0].values)) / entries)
    return rows.repartition(tasks) if tasks > 1 else rows


def classifier(algorithm: str) -> tuple[Estimator, bool]:
    """Estimator for a short name, and whether the name is known; unknown gives GBT."""
    known = algorithm in ALGORITHMS
    if not known:
        logger.warning("unknown algorithm %r, using gbt without a search", algorithm)
    return ALGORITHMS[algorithm if known else "gbt"](), known


def param_grid(estimator: Estimator, values: Mapping[str, Sequence]) -> list[dict]:
    """All combinations of the given parameter values."""
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(estimator.getParam(name), list(options))
    return builder.build()


def evaluator_for(metric: str) -> Evaluator:
    """Binary evaluator for the two area metrics, multiclass evaluator for all others."""
    if metric in BINARY_METRICS:
        return BinaryClassificationEvaluator(metricName=metric, numBins=0)
    return MulticlassClassificationEvaluator(metricName=metric)


class KeyedCrossValidator(CrossValidator):
    """Cross validation whose folds are filters on a fold column, in compiled code.

    The stock search checks a fold column with a Python UDF on every row of every fold.
    """

    def _kFold(self, dataset: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
        fold = named(self.getFoldCol())
        return [
            (dataset.where(fold != i), dataset.where(fold == i))
            for i in range(self.getNumFolds())
        ]


def cross_validate(
    train: DataFrame,
    algorithm: str,
    grid: Mapping[str, Sequence],
    metric: str = "accuracy",
    folds: int = FOLDS,
    parallelism: int = 4,
    seed: int = SEED,
    key: str | None = None,
) -> CrossValidatorModel:
    """Grid search with k folds; with a ``key`` the folds are fixed by its hash."""
    estimator, _ = classifier(algorithm)
    search = (KeyedCrossValidator if key is not None else CrossValidator)(
        estimator=estimator,
        estimatorParamMaps=param_grid(estimator, grid),
        evaluator=evaluator_for(metric),
        numFolds=folds,
        parallelism=parallelism,
        seed=seed,
    )
    if key is not None:
        search.setFoldCol("_fold")
        train = train.withColumn("_fold", hash_bucket(key, seed, folds))
    return search.fit(train)


def fit_classifier(
    train: DataFrame,
    algorithm: str = "gbt",
    grid: Mapping[str, Sequence] | None = None,
    metric: str = "accuracy",
    folds: int = FOLDS,
    parallelism: int = 4,
    seed: int = SEED,
    key: str | None = None,
) -> Model:
    """Fit on ``(features, label)`` rows; with a grid the best model of a search.

    The rows are kept on memory and disk during the fit, since every iteration
    reads them, and recomputed from their source if an executor is lost.
    """
    ensure_checkpoint_dir(train.sparkSession)
    estimator, known = classifier(algorithm)
    wanted = [FEATURES, "label", *([key] if key else [])]
    rows = spread(train.select(*wanted)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if grid and known:
            return cross_validate(
                rows, algorithm, grid, metric, folds, parallelism, seed, key
            ).bestModel
        return estimator.fit(rows)
    finally:
        rows.unpersist()


def cv_scores(spark: SparkSession, model: CrossValidatorModel, metric: str) -> DataFrame:
    """Mean score of each parameter combination that was tried."""
    rows = [
        (
            ",".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name)),
            metric,
            float(score),
        )
        for m, score in zip(model.getEstimatorParamMaps(), model.avgMetrics, strict=True)
    ]
    return spark.createDataFrame(rows, "params string, metric string, score double")


def param_map(model: Model) -> dict[str, str]:
    """Parameters of a fitted model as text."""
    return {p.name: str(v) for p, v in model.extractParamMap().items()}


def save_model(model: Model, path: str) -> str:
    """Save below ``path`` under the model's uid and return the uid."""
    model.write().overwrite().save(f"{path}/{model.uid}")
    return model.uid


def load_model(spark: SparkSession, path: str, uid: str) -> Model:
    """Load a saved model of any class; an unknown uid raises."""
    return DefaultParamsReader.loadParamsInstance(f"{path}/{uid}", spark)


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Score rows; the result stays distributed."""
    return model.transform(df)


def feature_names(transformed: DataFrame) -> list[str]:
    """Slot names of the assembled vector, from the metadata of ``features_raw``."""
    attributes = transformed.schema[RAW].metadata["ml_attr"]["attrs"]
    slots = [slot for group in attributes.values() for slot in group]
    return [slot["name"] for slot in sorted(slots, key=lambda s: s["idx"])]


def feature_importance(features: PipelineModel, model: Model, sample: DataFrame) -> DataFrame:
    """Importance per feature slot of a tree model, most important first.

    ``sample`` gives only the schema to name the slots; none of its rows is read.
    """
    names = feature_names(features.transform(sample))
    rows = sorted(
        zip(names, (float(x) for x in model.featureImportances.toArray()), strict=True),
        key=lambda row: (-row[1], row[0]),
    )
    return sample.sparkSession.createDataFrame(rows, "feature string, importance double")
