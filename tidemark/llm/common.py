"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.storage import workspace

# What separates words. Spaces are ASCII space and 0x09-0x0D; plain
# words are runs of digits, lower-case letters and everything beyond ASCII.
SPACES = r"[\x20\x09-\x0D]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Most bytes of text that one vectorised step holds at once, unless a single text is longer.
STEP_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder and read back.

    Cuts the lineage, and lets Spark know the size of what follows.
    """
    path = workspace(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; the fast path serves texts that are ASCII only."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def plain_words(text: Column) -> Column:
    """Words of the lower-cased text, in order; an empty array for null."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.filter(parts, lambda w: w != "")


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch cut into row ranges whose texts hold about STEP_BYTES together."""
    values = batch.column(column)
    sizes = np.asarray(
        pc.fill_null(pc.binary_length(values), 0), dtype=np.int64
    )
    total = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + STEP_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes, null as empty."""
    return [x or b"" for x in batch.column(column).to_pylist()]


def bytes_of(docs: DataFrame, *columns: str, text: str = "text") -> DataFrame:
    """The named columns and the text as bytes, which reach Python without decoding."""
    return docs.select(*columns, F.col(text).cast("binary").alias("text"))
