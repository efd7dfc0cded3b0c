"""From ingested rows to a registered model."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.defaults import CleanConfig, FeatureConfig, TrainConfig
from tidemark.functions import named
from tidemark.operators import clean, derive, evaluation, features, models, registry, sparse, split
from tidemark.sinks import save
from tidemark.sources.batch import read_table
from tidemark.sources.storage import exists


@dataclass(frozen=True)
class Home:
    """Where a flow keeps its tables and models, below one shared folder."""

    path: str

    @property
    def processed(self) -> str:
        return f"{self.path}/processed"

    @property
    def prepared(self) -> str:
        return f"{self.path}/prepared"

    @property
    def models(self) -> str:
        return f"{self.path}/models"

    @property
    def runs(self) -> str:
        return f"{self.path}/runs"

    @property
    def registry(self) -> str:
        return f"{self.path}/registry"

    def table(self, spark: SparkSession, path: str, schema: str) -> DataFrame:
        """Records kept so far; empty before the first are written."""
        if exists(spark, path):
            return spark.read.schema(schema).parquet(path)
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class TrainingResult:
    run_id: str
    model_uid: str
    metrics: dict[str, float]
    promoted: bool


def with_row_key(df: DataFrame, key: str) -> DataFrame:
    """The rows with a key: their own, or a hash of all columns when it was dropped."""
    if key in df.columns:
        return df
    return df.withColumn(key, F.xxhash64(*[named(c) for c in df.columns]))


def train_and_promote(
    spark: SparkSession,
    source: DataFrame,
    home: Home,
    name: str,
    cleaning: CleanConfig,
    feature: FeatureConfig,
    training: TrainConfig,
    partitions: Sequence[str] = (),
) -> TrainingResult:
    """Clean, bin, split, fit, evaluate, save, record and judge one model.

    Rows without a label are left out. Features are fitted on the training part only,
    and saved with the classifier as one model. Cleaned and prepared rows are written
    once each, so the fits read a narrow table rather than repeat the cleaning.
    """
    cleaned = clean.clean(source, cleaning)
    save(cleaned, home.processed, partitions=partitions)
    processed = read_table(spark, home.processed, schema=cleaned.schema)
    binned = with_row_key(derive.bin_columns(processed, feature.bins), feature.key)

    prepared = features.prepare(binned, feature).where("label IS NOT NULL")
    tagged = split.tag_split(prepared, feature.key, training.split_ratio, training.seed, "_part")
    save(tagged, home.prepared, partitions=["_part"])
    rows = read_table(spark, home.prepared)
    train = rows.where("_part = 'train'").drop("_part")
    test = rows.where("_part = 'test'").drop("_part")

    if feature.wide:
        uid = sparse.new_wide_uid()
        fitted = sparse.fit_sparse(train, prepared_config(feature), sparse.features_path(home.models, uid))
        vectors = fitted.vectors(train)
    else:
        fitted = features.fit_features(train, prepared_config(feature))
        vectors = fitted.transform(train)
    model = models.fit_classifier(
        vectors,
        training.algorithm,
        training.grid,
        training.metric,
        training.folds,
        training.parallelism,
        training.seed,
        feature.key,
    )
    if feature.wide:
        whole = sparse.WideModel(fitted, model)
        model_uid = sparse.save_wide(model, home.models, uid)
    else:
        whole = PipelineModel(stages=[*fitted.stages, model])
        model_uid = models.save_model(whole, home.models)
    metrics = evaluation.evaluate_model(whole, test)

    run_id = uuid.uuid4().hex
    record = registry.run_record(
        spark, run_id, model_uid, models.param_map(model), metrics, {"model_name": model.uid}
    )
    record.coalesce(1).write.mode("append").parquet(home.runs)

    candidates = spark.createDataFrame([(name, run_id)], "name string, run_id string")
    decisions = registry.promotion_decisions(
        candidates,
        home.table(spark, home.runs, registry.RUNS),
        home.table(spark, home.registry, registry.REGISTRY),
        training.metric,
        training.margin,
    )
    # One candidate, so one row; collected so that the append does not read its own target.
    accepted = registry.promotions(decisions).collect()
    if accepted:
        spark.createDataFrame(accepted, registry.REGISTRY).coalesce(1).write.mode(
            "append"
        ).parquet(home.registry)
    return TrainingResult(run_id, model_uid, metrics, bool(accepted))


def prepared_config(feature: FeatureConfig) -> FeatureConfig:
    """Config for prepared rows, whose label column is named ``label``."""
    return FeatureConfig(
        key=feature.key,
        label="label",
        nulls=feature.nulls,
        wide=feature.wide,
    )
