"""Incremental file source with a persisted schema."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.storage import is_committed


def stored_schema(spark: SparkSession, schema_path: str) -> T.StructType | None:
    """Schema kept by an earlier run, or None."""
    if not is_committed(spark, schema_path):
        return None
    text = spark.read.text(schema_path, wholetext=True).first()[0]
    return T.StructType.fromJson(json.loads(text))


def store_schema(spark: SparkSession, schema: T.StructType, schema_path: str) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(schema_path)


def resolve_schema(
    spark: SparkSession, path: str, fmt: str, schema_path: str, **options: str
) -> T.StructType:
    """Kept schema, with the columns that files present have beyond it; the result is kept.

    A column whose type has changed raises.
    """
    kept = stored_schema(spark, schema_path)
    merged = {"mergeSchema": "true"} if fmt in ("parquet", "orc") else {}
    found = spark.read.format(fmt).options(**{**merged, **options}).load(path).schema
    known = {f.name: f.dataType for f in kept or ()}
    changed = [f.name for f in found if f.name in known and f.dataType != known[f.name]]
    if changed:
        raise ValueError(f"columns of files below {path} have another type: {changed}")
    schema = T.StructType([*(kept or ()), *[f for f in found if f.name not in known]])
    if schema != kept:
        store_schema(spark, schema, schema_path)
    return schema


def read_file_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    schema_path: str | None = None,
    max_files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """Stream the files that arrive below ``path``.

    Give a schema, or a ``schema_path`` where the inferred one is kept for later
    runs, which add columns that have appeared. ``max_files_per_batch`` cuts a large backlog into several batches.
    """
    if schema is None:
        if schema_path is None:
            raise ValueError("a file stream needs schema or schema_path")
        schema = resolve_schema(spark, path, fmt, schema_path, **options)
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.load(path)
