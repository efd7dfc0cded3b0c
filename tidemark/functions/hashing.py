"""Row hashing that does not depend on how the data is partitioned."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.columns import named


def hash_bucket(key: str, seed: int, buckets: int = 100) -> Column:
    """Bucket ``0 .. buckets-1`` from the first 32 bits of ``md5(key:seed)``.

    A recomputed or re-partitioned row always lands in the same bucket, so splits
    stay disjoint when a lost executor forces a stage to run again.
    """
    return F.pmod(hash_number(key, seed), F.lit(buckets)).cast("int")


def hash_number(key: str, seed: int) -> Column:
    """The first 32 bits of ``md5(key:seed)`` as a number."""
    digest = F.md5(F.concat(named(key).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
