"""Batch scoring with the registered model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.defaults import CleanConfig, FeatureConfig
from tidemark.operators import clean, derive, features, models, registry, sparse
from tidemark.plans.training import Home, with_row_key


def score_with_champion(
    spark: SparkSession,
    source: DataFrame,
    home: Home,
    name: str,
    cleaning: CleanConfig,
    feature: FeatureConfig,
) -> DataFrame:
    """Key and prediction for each cleaned row, by the newest registered version.

    The saved model carries the fitted features, so nothing is fitted on the rows
    to score and they need no label.
    """
    found = registry.champion_model(
        home.table(spark, home.runs, registry.RUNS),
        home.table(spark, home.registry, registry.REGISTRY),
        name,
    )
    if found is None:
        raise LookupError(f"no registered model named {name!r}")
    _, uid = found
    load = sparse.load_wide if sparse.is_wide(spark, home.models, uid) else models.load_model
    model = load(spark, home.models, uid)
    cleaned = derive.bin_columns(clean.clean(source, cleaning), feature.bins)
    rows = features.prepare(with_row_key(cleaned, feature.key), feature)
    return models.predict(model, rows).select(feature.key, "prediction")
