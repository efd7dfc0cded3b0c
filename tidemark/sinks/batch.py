"""Batch sinks: overwrite, partitioned, counted, create-if-absent, catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from tidemark.functions import named, quoted


def _layout(df: DataFrame, partitions: Sequence[str], repartition: int | None) -> DataFrame:
    """Bring rows of one partition value together, without one task per value.

    The rebalance hint lets adaptive execution split a value that holds a large
    share of the rows and merge small ones, so neither giant tasks nor a file per
    task and value result.
    """
    if repartition is not None:
        return df.repartition(repartition)
    if partitions:
        return df.hint("rebalance", *[named(p) for p in partitions])
    return df


def _writer(
    df: DataFrame, fmt: str, partitions: Sequence[str], mode: str, options: dict[str, str]
) -> DataFrameWriter:
    writer = df.write.format(fmt).options(**options).mode(mode)
    return writer.partitionBy(*partitions) if partitions else writer


def save(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partitions: Sequence[str] = (),
    repartition: int | None = None,
    **options: str,
) -> None:
    """Overwrite a path, optionally in partition directories or a set number of files."""
    rows = _layout(df, partitions, repartition)
    _writer(rows, fmt, partitions, "overwrite", options).save(path)


def save_counted(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partitions: Sequence[str] = (),
    repartition: int | None = None,
    **options: str,
) -> int:
    """Overwrite a path and return the rows it then holds.

    The input is computed once, by the write. The count comes from the written
    files, for Parquet and ORC from their footers alone, for JSON from its lines, unparsed. CSV is
    read again, since a field may hold line ends. It is not observed during
    the write: a session that has used an ``Observation`` can no longer ship freshly
    fitted MLlib models to its tasks, because their summaries refer to the session.
    """
    save(df, path, fmt, partitions, repartition, **options)
    reader = df.sparkSession.read.options(**options)
    if fmt == "json":
        # A row is a line: line ends inside texts are escaped.
        return reader.text(path).count()
    return reader.format(fmt).schema(df.schema).load(path).count()


def save_if_absent(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partitions: Sequence[str] = (),
    **options: str,
) -> None:
    """Write only when the path does not exist yet."""
    _writer(_layout(df, partitions, None), fmt, partitions, "ignore", options).save(path)


def publish_table(df: DataFrame, name: str, path: str, fmt: str = "parquet") -> None:
    """Publish as a catalog table stored at ``path``.

    The path is explicit: a session-local catalog forgets the table but leaves a
    managed directory behind, which would block the next session.
    """
    df.write.format(fmt).mode("overwrite").option("path", path).saveAsTable(name)


def publish_location(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """Publish files already at ``path`` as a catalog table, without copying them."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "MANAGED":
        raise ValueError(f"{name} is a managed table; dropping it would delete its files")
    spark.sql(f"DROP TABLE IF EXISTS {'.'.join(quoted(part) for part in name.split('.'))}")
    spark.catalog.createTable(name, path=path, source=fmt)
