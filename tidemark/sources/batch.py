"""Batch scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """CSV with a header line; fields that do not parse become NULL.

    Without a schema the types are inferred, which costs one more pass over the
    files. Give a schema for large inputs.
    """
    reader = spark.read.options(**options)
    if schema is not None:
        return reader.csv(path, header=True, schema=schema, mode="PERMISSIVE")
    return reader.csv(path, header=True, inferSchema=True, mode="PERMISSIVE")


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Scan a path in any batch format the session knows (parquet, orc, json, delta, ...).

    Give the schema when the files are partitioned by string columns: their values are
    otherwise read as numbers where they look like numbers.
    """
    reader = spark.read.format(fmt).options(**options)
    return (reader if schema is None else reader.schema(schema)).load(path)


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a table published in the session catalog."""
    return spark.read.table(name)
