"""Permutation importance, for a model of any kind."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.defaults import SEED
from tidemark.functions import hash_number, named
from tidemark.operators.features import FEATURES

# Hash ranges of which each is numbered by one task.
RANGES = 1024


def hash_ranks(df: DataFrame, key: str, seed: int = SEED, ranges: int = RANGES) -> DataFrame:
    """``df`` with ``rank``: each row's place, from 0, in the order of its key's hash, then key.

    Hashes spread evenly, so ranges of them hold about as many rows each; one is numbered per
    task, and counts per range carry the numbers on. Nothing depends on how ``df`` is
    partitioned. Keys are unique.
    """
    number = hash_number(key, seed)
    part = F.floor(number / (2**32 // ranges)).cast("int")
    placed = df.withColumns({"_hash": number, "_range": part})
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_range").orderBy("_hash", named(key))
    ranked = placed.withColumn("_place", F.row_number().over(within) - 1).join(starts, "_range")
    return ranked.withColumn("rank", F.col("_start") + F.col("_place")).drop("_hash", "_range", "_start", "_place")


def permutation_importance(
    model: Model, rows: DataFrame, width: int, key: str, label: str = "label", seed: int = SEED
) -> DataFrame:
    """``(slot, accuracy, importance)`` of each of ``width`` feature slots: the accuracy lost without it.

    A slot is emptied of meaning by a permutation: in the order of the keys' hashes, a row gets slot j from
    the row j + 1 places before it, the first ones from the last. So one numbering serves all slots,
    each is permuted differently, and all altered rows are scored in one pass. Every row sends one value
    per slot and is scored once per slot. Meant for dense features.
    """
    values = hash_ranks(
        rows.select(named(key), named(label).cast("double").alias("label"), vector_to_array(FEATURES).alias("values")), key, seed
    )
    total = rows.agg(F.count(F.lit(1))).scalar()
    slots = F.posexplode("values").alias("slot", "given")
    given = values.select("rank", slots).select(
        F.pmod(F.col("rank") + F.col("slot") + 1, total).alias("rank"), "slot", "given"
    )
    altered = values.join(given, "rank").select(
        "label",
        "slot",
        array_to_vector(
            F.transform("values", lambda x, i: F.when(i == F.col("slot"), F.col("given")).otherwise(x))
        ).alias(FEATURES),
    )
    hit = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    plain = rows.select(named(label).cast("double").alias("label"), FEATURES)
    accuracy = model.transform(plain).agg(hit).scalar()
    found = model.transform(altered.where(F.col("slot") < width)).groupBy("slot").agg(hit.alias("accuracy"))
    return found.select("slot", "accuracy", (accuracy - F.col("accuracy")).alias("importance"))
