"""Cleaning: drop, rename, project, filter and deduplicate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.defaults import CleanConfig
from tidemark.functions import is_missing, named, quoted, unused


def drop_columns(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Without the listed columns; unknown names are ignored."""
    return df.drop(*columns) if columns else df


def normalise_names(df: DataFrame) -> DataFrame:
    """Column names with spaces turned into underscores."""
    return df.toDF(*[name.strip().replace(" ", "_") for name in df.columns])


def project_label(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Listed columns plus the label as a double named ``label``."""
    return df.select(*[named(c) for c in columns], named(label).cast("double").alias("label"))


def drop_missing_rows(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Without rows that have NULL or NaN in any listed column; all rows when none is listed."""
    return df.dropna(how="any", subset=[quoted(c) for c in columns]) if columns else df


def missing_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value in ``column`` counts as missing."""
    return df.where(is_missing(df.schema[column]))


def head(df: DataFrame, order_by: Sequence[str], n: int = 2) -> DataFrame:
    """First ``n`` rows in a stated order."""
    return df.orderBy(*[named(c) for c in order_by]).limit(n)


def _sortable(data_type: T.DataType) -> bool:
    return not any(kind in data_type.simpleString() for kind in ("map<", "variant"))


def first_per_key(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """One row per key: the first in the order, ties settled by the other columns.

    ``row_number() = 1`` is pruned to one row per key in every map task before the
    shuffle (WindowGroupLimit), so a key that holds a large share of all rows does
    not reach one task whole.
    """
    given = set(key) | set(order_by)
    rest = [f.name for f in df.schema if f.name not in given and _sortable(f.dataType)]
    turn = F.desc if descending else F.asc
    order = [turn(quoted(c)) for c in [*order_by, *rest]]
    rank = F.row_number().over(Window.partitionBy(*[named(c) for c in key]).orderBy(*order))
    place = unused(df.columns, "_rank")
    return df.withColumn(place, rank).where(named(place) == 1).drop(place)


def deduplicate(
    df: DataFrame, columns: Sequence[str] = (), order_by: Sequence[str] = ()
) -> DataFrame:
    """Distinct rows; with ``columns`` one row for each of their values.

    An empty list means all columns.
    """
    if not columns:
        return df.dropDuplicates()
    return first_per_key(df, columns, order_by)


def clean(df: DataFrame, config: CleanConfig) -> DataFrame:
    """Drop columns, then rows with gaps, then duplicates.

    Because the key is usually dropped first, distinct customers with equal
    attributes collapse; ``dedup_first`` removes duplicates before that.
    """
    if config.dedup_first:
        deduped = deduplicate(df, config.dedup)
        return drop_missing_rows(drop_columns(deduped, config.drop), config.dropna)
    kept = drop_missing_rows(drop_columns(df, config.drop), config.dropna)
    return deduplicate(kept, config.dedup)
