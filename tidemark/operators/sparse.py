"""Features for wide categories: one-hots stay sparse, the index is a table.

The dense path (``features``) holds every category's vocabulary on the driver and subtracts a
mean from every slot, so that each vector gets as many numbers as there are categories. Here a
category's values are numbered by the distributed ``frequency_index`` and saved as a table beside
the model; only numbers are centred and scaled, and a row holds one entry for each of its own
values. What the driver keeps is one record per input column.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.defaults import FeatureConfig
from tidemark.functions import named, unused
from tidemark.operators.features import FEATURES, feature_columns, frequency_index
from tidemark.operators.models import load_model
from tidemark.sources.storage import exists, workspace

SLOTS = "slots"
INDEX = "column string, value string, idx long"
COLUMNS = "place int, column string, categorical boolean, slots long, mean double, deviation double"


@dataclass(frozen=True)
class InputColumn:
    """A fitted input: how many slots it takes from ``start`` on, and how numbers are scaled."""

    name: str
    categorical: bool
    slots: int
    start: int
    mean: float | None
    deviation: float | None


def _present(column: str) -> Column:
    """The number, NULL for NaN."""
    return F.nanvl(named(column).cast("double"), F.lit(None).cast("double"))


def _moments(df: DataFrame, numbers: list[str], nulls: str) -> dict[str, tuple[float | None, float | None]]:
    """Mean and sample deviation of each column, in one aggregate.

    With ``impute`` gaps count as the mean, as they will when filled.
    """
    if not numbers:
        return {}

    def both(name: str) -> Column:
        spread = F.var_pop(_present(name)) * F.count(_present(name))
        rows = F.count(F.lit(1)) if nulls == "impute" else F.count(_present(name))
        deviation = F.sqrt(F.try_divide(spread, rows - 1))
        return F.struct(F.avg(_present(name)).alias("mean"), deviation.alias("deviation"))

    found = df.agg(*[both(c).alias(f"c{i}") for i, c in enumerate(numbers)]).first()
    return {c: (found[i]["mean"], found[i]["deviation"]) for i, c in enumerate(numbers)}


def fit_sparse(df: DataFrame, config: FeatureConfig, path: str) -> SparseFeatures:
    """Fit on prepared training rows, and save below ``path``.

    Slots: the values of each category by frequency, ties by name, category after category, then the numbers.
    """
    if config.nulls not in ("impute", "drop", "keep"):
        raise ValueError(f"nulls must be impute, drop or keep, not {config.nulls!r}")
    spark = df.sparkSession
    categories, numbers = feature_columns(df, config)
    index = spark.createDataFrame([], INDEX)
    for column in categories:
        index = index.unionByName(frequency_index(df, column).select(F.lit(column).alias("column"), "value", "idx"))
    index.write.mode("overwrite").partitionBy("column").parquet(f"{path}/index")
    counts = _index(spark, path).groupBy("column").agg(F.count(F.lit(1)).alias("n"))
    slots = {r["column"]: r["n"] for r in counts.collect()}
    moments = _moments(df, numbers, config.nulls)
    rows = [(i, c, True, slots.get(c, 0), None, None) for i, c in enumerate(categories)]
    rows += [(len(categories) + i, c, False, 1, *moments[c]) for i, c in enumerate(numbers)]
    # The last to be written: a fit without it is not complete.
    records = spark.createDataFrame(rows, COLUMNS).withColumn("nulls", F.lit(config.nulls))
    records.coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")
    return load_sparse(spark, path)


def _index(spark: SparkSession, path: str) -> DataFrame:
    """The index table; the schema is given, or column names that look like numbers would be read as such."""
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def load_sparse(spark: SparkSession, path: str) -> SparseFeatures:
    """Fitted features that were saved below ``path``."""
    rows = spark.read.schema(f"{COLUMNS}, nulls string").parquet(f"{path}/columns").orderBy("place").collect()
    start, columns = 0, []
    for r in rows:
        columns.append(InputColumn(r["column"], r["categorical"], r["slots"], start, r["mean"], r["deviation"]))
        start += r["slots"]
    return SparseFeatures(path, tuple(columns), rows[0]["nulls"] if rows else "impute")


@dataclass(frozen=True)
class SparseFeatures:
    """Fitted features: the index table below ``path``, and a record per input column."""

    path: str
    columns: tuple[InputColumn, ...]
    nulls: str

    @property
    def width(self) -> int:
        return sum(c.slots for c in self.columns)

    def _number(self, column: InputColumn) -> Column:
        value = _present(column.name)
        if not column.deviation:
            # A column that did not vary, or had no values, says nothing.
            return F.lit(0.0)
        scaled = (value - F.lit(column.mean)) / F.lit(column.deviation)
        # A filled gap is the mean and so 0; a kept one stays NaN.
        return F.coalesce(scaled, F.lit(float("nan") if self.nulls == "keep" else 0.0))

    def slots(self, df: DataFrame) -> DataFrame:
        """``df`` with ``slots``: an array of ``(slot, value)`` in order of slot, zeros left out.

        A NULL category and a value not seen in fitting set no slot. Each category is one join with
        its part of the index; how that reaches the rows is left to Spark's size statistics.
        """
        entries, kept = [], list(df.columns)
        for i, column in enumerate(self.columns):
            if column.categorical:
                value, idx = unused(df.columns, f"_value{i}"), unused(df.columns, f"_idx{i}")
                index = _index(df.sparkSession, self.path).where(F.col("column") == column.name)
                index = index.select(F.col("value").alias(value), F.col("idx").alias(idx))
                df = df.join(index, named(column.name) == named(value), "left").drop(value)
                slot, number, here = named(idx) + column.start, F.lit(1.0), named(idx).isNotNull()
            else:
                slot, number = F.lit(column.start), self._number(column)
                here = number != 0
            entry = F.struct(slot.cast("int").alias("slot"), number.alias("value"))
            entries.append(F.when(here, entry))
        if not entries:
            return df.withColumn(SLOTS, F.expr("cast(array() as array<struct<slot:int,value:double>>)"))
        return df.select(*[named(c) for c in kept], F.array_compact(F.array(*entries)).alias(SLOTS))

    def vectors(self, df: DataFrame, path: str | None = None) -> DataFrame:
        """``slots(df)`` with the sparse vector ``features``, written once below ``path``.

        Spark keeps a vector as a struct in files, so rows written as that struct are read back as
        vectors: no function is called per row, and no metadata names each slot.
        """
        spark = df.sparkSession
        path = path or workspace(spark)
        vector = F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            F.lit(self.width).alias("size"),
            F.transform(SLOTS, lambda s: s["slot"]).alias("indices"),
            F.transform(SLOTS, lambda s: s["value"]).alias("values"),
        )
        rows = self.slots(df).withColumn(FEATURES, vector)
        rows.write.mode("overwrite").parquet(path)
        fields = [T.StructField(f.name, VectorUDT() if f.name == FEATURES else f.dataType) for f in rows.schema]
        return spark.read.schema(T.StructType(fields)).parquet(path)


@dataclass(frozen=True)
class WideModel:
    """A classifier with the sparse features it was fitted on."""

    features: SparseFeatures
    classifier: Model

    def transform(self, df: DataFrame) -> DataFrame:
        """Scored rows; their vectors are written once on the way."""
        return self.classifier.transform(self.features.vectors(df))


def new_wide_uid() -> str:
    return f"wide_{uuid.uuid4().hex[:12]}"


def features_path(path: str, uid: str) -> str:
    """Where the model ``uid`` below ``path`` keeps its features."""
    return f"{path}/{uid}/features"


def save_wide(classifier: Model, path: str, uid: str) -> str:
    """Save the classifier beside the features already below ``path``; returns ``uid``."""
    classifier.write().overwrite().save(f"{path}/{uid}/classifier")
    return uid


def is_wide(spark: SparkSession, path: str, uid: str) -> bool:
    return exists(spark, features_path(path, uid))


def load_wide(spark: SparkSession, path: str, uid: str) -> WideModel:
    """A saved classifier with its index, whatever its class."""
    return WideModel(load_sparse(spark, features_path(path, uid)), load_model(spark, f"{path}/{uid}", "classifier"))
