"""Sampling and train/test splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.defaults import SEED, SPLIT_RATIO
from tidemark.functions import hash_number, unused, named


def sample(df: DataFrame, fraction: float, seed: int = SEED) -> DataFrame:
    """Bernoulli sample without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_by_hash(df: DataFrame, key: str, fraction: float, seed: int = SEED) -> DataFrame:
    """Bernoulli sample that depends on the key alone, not on how ``df`` is partitioned.

    Rows with a NULL key are left out.
    """
    return df.where(hash_number(key, seed) < round(fraction * 2**32))


def tag_split(
    df: DataFrame, key: str, ratio: float = SPLIT_RATIO, seed: int = SEED, output: str = "part"
) -> DataFrame:
    """Adds ``train`` or ``test`` by a hash of the key: one rule for every ratio."""
    train = hash_number(key, seed) < round((1 - ratio) * 2**32)
    return df.withColumn(output, F.when(train, "train").otherwise("test"))


def split_by_hash(
    df: DataFrame, key: str, ratio: float = SPLIT_RATIO, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Train and test parts that depend on the key alone.

    A narrow filter: no sort and no shuffle, and the same parts on any cluster.
    NULL keys go to the test part.
    """
    part = unused(df.columns, "_part")
    tagged = tag_split(df, key, ratio, seed, part)
    return (
        tagged.where(named(part) == "train").drop(part),
        tagged.where(named(part) == "test").drop(part),
    )


def split_random(
    df: DataFrame, ratio: float = SPLIT_RATIO, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Spark's ``randomSplit``; the parts depend on how ``df`` is partitioned."""
    train, test = df.randomSplit([1 - ratio, ratio], seed)
    return train, test
