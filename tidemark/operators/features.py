"""Feature stages: index, one-hot, impute, assemble, scale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.defaults import FeatureConfig
from tidemark.functions import categorical_columns, named, numeric_columns, unused
from tidemark.operators.clean import drop_missing_rows
from tidemark.sources.storage import workspace

RAW = "features_raw"
FEATURES = "features"


def frequency_index(df: DataFrame, column: str) -> DataFrame:
    """``(value, idx)``: each value's place by frequency, ties by name, counted from 0.

    The values are counted, sorted over all tasks and numbered part by part, so there
    may be any number of them. They are written once, which fixes the order.
    """
    counts = (
        df.where(named(column).isNotNull())
        .groupBy(named(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = [F.desc("n"), F.asc("value")]
    # The id holds the part in its upper bits and the place within it in the lower 33.
    placed = counts.repartitionByRange(*order).sortWithinPartitions(*order)
    path = workspace(df.sparkSession)
    placed.select("value", F.monotonically_increasing_id().alias("id")).write.parquet(path)
    rows = df.sparkSession.read.parquet(path).select(
        "value", F.shiftright("id", 33).alias("part"), F.col("id").bitwiseAND(2**33 - 1).alias("place")
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part of the sort.
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return rows.join(parts, "part").select("value", (F.col("before") + F.col("place")).alias("idx"))


def string_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``<column>_idx``: place by frequency, ties by name; NULL gets the next index after all.

    The index is a table joined to the rows, not a vocabulary on the driver.
    """
    for column in columns:
        index = frequency_index(df, column)
        values, idx = (unused(df.columns, n) for n in ("_value", "_idx"))
        index = index.select(F.col("value").alias(values), F.col("idx").cast("double").alias(idx))
        after = index.agg(F.count(F.lit(1)).cast("double")).scalar()
        joined = df.join(index, named(column) == named(values), "left")
        df = joined.withColumn(f"{column}_idx", F.coalesce(named(idx), after)).drop(values, idx)
    return df


def one_hot_slots(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``(keep, column, slot)``: the one slot set for each row and column, whatever their number.

    Slots count on from column to column; a NULL sets none.
    """
    start, rows = F.lit(0).cast("bigint"), None
    for column in columns:
        index = frequency_index(df, column).withColumnRenamed("value", "_value")
        slots = df.join(index, named(column) == F.col("_value")).select(
            *[named(k) for k in keep], F.lit(column).alias("column"), (F.col("idx") + start).alias("slot")
        )
        rows = slots if rows is None else rows.unionByName(slots)
        start = start + index.agg(F.count(F.lit(1))).scalar()
    return rows


def one_hot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``<column>_vec``; a value not seen in fitting is all zeros."""
    return Pipeline(stages=[_indexer(columns), _encoder(columns)]).fit(df).transform(df)


def assemble(df: DataFrame, vectors: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    """Adds ``features_raw`` from vector columns, then numbers; NULL becomes NaN."""
    return _assembler(vectors, numbers, "keep").transform(df)


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``features``: columns less their mean, divided by their sample deviation."""
    stages = [_assembler([], columns, "error"), _scaler()]
    return Pipeline(stages=stages).fit(df).transform(df)


def vector_slots(df: DataFrame, vector: str, keep: Sequence[str]) -> DataFrame:
    """One row per slot of a vector column, as ``(keep, slot, value)``; NaN becomes NULL."""
    slots = df.select(
        *[named(c) for c in keep],
        F.posexplode(vector_to_array(named(vector))).alias("slot", "number"),
    )
    value = F.when(~F.isnan("number"), F.col("number"))
    return slots.select(*[named(c) for c in keep], "slot", value.alias("value"))


def prepare(df: DataFrame, config: FeatureConfig) -> DataFrame:
    """Key, label (where present), categories and numbers as double, nothing else."""
    categories, numbers = feature_columns(df, config)
    ids = [named(config.key)] if config.key in df.columns else []
    label = (
        [named(config.label).cast("double").alias("label")]
        if config.label and config.label in df.columns
        else []
    )
    rows = df.select(
        *ids,
        *label,
        *[named(c) for c in categories],
        *[named(c).cast("double").alias(c) for c in numbers],
    )
    return drop_missing_rows(rows, numbers) if config.nulls == "drop" else rows


def feature_columns(df: DataFrame, config: FeatureConfig) -> tuple[list[str], list[str]]:
    """Categorical and numeric inputs by type, without key, label and exclusions."""
    skip = [config.key, *config.exclude, *([config.label] if config.label else [])]
    return categorical_columns(df.schema, skip), numeric_columns(df.schema, skip)


def feature_stages(
    categories: Sequence[str], numbers: Sequence[str], nulls: str = "impute"
) -> list:
    """Unfitted stages from prepared columns to the scaled vector ``features``.

    All category columns share one indexer and one encoder, so fitting takes one
    job for them rather than one per column. ``nulls`` says what happens to gaps
    in numbers: ``impute`` puts the mean of the training rows, ``drop`` expects
    rows with gaps to be gone, ``keep`` passes NaN on.
    """
    if nulls not in ("impute", "drop", "keep"):
        raise ValueError(f"nulls must be impute, drop or keep, not {nulls!r}")
    stages: list = []
    if categories:
        stages += [_indexer(categories), _encoder(categories)]
    inputs = list(numbers)
    if nulls == "impute" and numbers:
        inputs = [f"{c}_filled" for c in numbers]
        stages.append(Imputer(inputCols=list(numbers), outputCols=inputs, strategy="mean"))
    handling = "keep" if nulls == "keep" else "error"
    return [*stages, _assembler([f"{c}_vec" for c in categories], inputs, handling), _scaler()]


def fit_features(df: DataFrame, config: FeatureConfig) -> PipelineModel:
    """Fit the feature stages on prepared training rows."""
    categories, numbers = feature_columns(df, config)
    return Pipeline(stages=feature_stages(categories, numbers, config.nulls)).fit(df)


def _indexer(columns: Sequence[str]) -> StringIndexer:
    return StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_idx" for c in columns], handleInvalid="keep"
    )


def _encoder(columns: Sequence[str]) -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_vec" for c in columns]
    )


def _assembler(vectors: Sequence[str], numbers: Sequence[str], handling: str) -> VectorAssembler:
    return VectorAssembler(
        inputCols=[*vectors, *numbers], outputCol=RAW, handleInvalid=handling
    )


def _scaler() -> StandardScaler:
    return StandardScaler(inputCol=RAW, outputCol=FEATURES, withMean=True, withStd=True)
