"""Profiling in one pass over the data: summaries, gaps, rates, correlations, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import (
    categorical_columns,
    is_missing,
    named,
    numeric_columns,
    pairwise_corr,
    percent,
)

def _rows(df: DataFrame, rows: Sequence[Column]) -> DataFrame:
    """One aggregate over the whole table, returned as one row per given struct."""
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def schema_report(df: DataFrame) -> DataFrame:
    """Name, type and nullability of each column, with the table's row count."""
    return _rows(
        df,
        [
            F.struct(
                F.lit(f.name).alias("name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.lit(f.nullable).alias("nullable"),
                F.count(F.lit(1)).alias("row_count"),
            )
            for f in df.schema
        ],
    )


def column_roles(df: DataFrame, label: str | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Each column as categorical (string), numeric or label, with its present values."""
    skip = [*exclude, *([label] if label else [])]
    roles = {
        **{c: "categorical" for c in categorical_columns(df.schema, skip)},
        **{c: "numeric" for c in numeric_columns(df.schema, skip)},
        **({label: "label"} if label else {}),
    }
    return _rows(
        df,
        [
            F.struct(
                F.lit(name).alias("column"),
                F.lit(roles[name]).alias("role"),
                F.count(named(name)).alias("value_count"),
            )
            for name in df.columns
            if name in roles
        ],
    )


def describe(df: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of numeric and string columns.

    Typed: numbers stay numbers in ``min_value``/``max_value``, strings go to
    ``min_text``/``max_text``.
    """

    def summary(field: T.StructField) -> Column:
        column = named(field.name)
        textual = isinstance(field.dataType, T.StringType)
        number, text = (None, column) if textual else (column.cast("double"), None)

        def of(aggregate, value, kind):
            return aggregate(value) if value is not None else F.lit(None).cast(kind)

        return F.struct(
            F.lit(field.name).alias("column"),
            F.count(column).alias("count"),
            of(F.avg, number, "double").alias("mean"),
            of(F.stddev_samp, number, "double").alias("stddev"),
            of(F.min, number, "double").alias("min_value"),
            of(F.max, number, "double").alias("max_value"),
            of(F.min, text, "string").alias("min_text"),
            of(F.max, text, "string").alias("max_text"),
        )

    fields = [f for f in df.schema if isinstance(f.dataType, (T.NumericType, T.StringType))]
    return _rows(df, [summary(f) for f in fields])


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, as count and percentage, in one pass."""
    total = F.count(F.lit(1))

    def gaps(field: T.StructField) -> Column:
        count = F.count_if(is_missing(field))
        return F.struct(
            F.lit(field.name).alias("column"),
            count.alias("null_count"),
            percent(count, total).alias("null_percent"),
        )

    return _rows(df, [gaps(f) for f in df.schema])


def rate_by_category(df: DataFrame, value: str, categories: Sequence[str]) -> DataFrame:
    """Mean of a 0/1 column and row count for every value of every category column.

    All category columns share one scan and one shuffle of partial aggregates.
    """
    narrow = df.select(
        named(value).alias("_value"), *[named(c).cast("string").alias(c) for c in categories]
    )
    return (
        narrow.unpivot(["_value"], [named(c) for c in categories], "column", "category")
        .groupBy("column", "category")
        .agg(F.avg("_value").alias(f"{value}_rate"), F.count(F.lit(1)).alias("count"))
        .orderBy("column", F.desc(f"{value}_rate"), "category")
    )


def corr_with_label(
    df: DataFrame, label: str, columns: Sequence[str], nulls_as_zero: bool = False
) -> DataFrame:
    """Absolute correlation of each column with the label, strongest first."""
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.abs(pairwise_corr(named(c), named(label), nulls_as_zero)).alias("abs_corr"),
        )
        for c in columns
    ]
    return _rows(df, rows).orderBy(F.desc_nulls_last("abs_corr"), "column")


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full correlation matrix as rows ``(x, y, r)``, from one scan whatever the number of columns.

    Each row is taken once per column, with that column's value beside all others, so one
    grouped aggregate with a group per column holds the whole matrix.
    """
    places = [f"c{i}" for i in range(len(columns))]
    narrow = df.select(*[named(c).cast("double").alias(p) for c, p in zip(columns, places)])
    pairs = [F.struct(F.lit(i).alias("i"), F.col(p).alias("value")) for i, p in enumerate(places)]
    moments = [pairwise_corr(F.col("value"), F.col(p)).alias(p) for p in places]
    varies = (F.stddev_pop(F.nanvl("value", F.lit(None).cast("double"))) > 0).alias("varies")
    grouped = narrow.select(F.inline(F.array(*pairs)), *places).groupBy("i").agg(*moments, varies)
    names = F.array(*[F.lit(c) for c in columns])
    own = F.when(F.col("varies"), F.lit(1.0))
    entries = [
        F.struct(
            F.lit(c).alias("y"), F.when(F.col("i") == i, own).otherwise(F.col(p)).alias("r")
        )
        for i, (c, p) in enumerate(zip(columns, places))
    ]
    return grouped.select(names[F.col("i")].alias("x"), F.inline(F.array(*entries)))


def hist_by_label(df: DataFrame, label: str, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Rows per label and equal-width bin of each column; empty bins are left out.

    The ranges come from a scalar subquery over the same columns, so the data is
    scanned twice and never joined.
    """
    nothing = F.lit(None).cast("double")
    narrow = df.select(
        named(label).alias(label),
        *[F.nanvl(named(c).cast("double"), nothing).alias(c) for c in columns],
    )
    ranges = [
        F.struct(F.min(named(c)).alias("low"), F.max(named(c)).alias("high")).alias(c)
        for c in columns
    ]
    span = narrow.agg(F.struct(*ranges).alias("span")).scalar()

    def bin_of(name: str) -> Column:
        low, high = span[name]["low"], span[name]["high"]
        place = F.floor(F.try_divide(named(name) - low, (high - low) / bins))
        # The maximum belongs to the last bin; a column that does not vary to the first.
        inside = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1))
        return F.when(named(name).isNotNull(), inside)

    return (
        narrow.select(named(label), *[bin_of(c).cast("int").alias(c) for c in columns])
        .unpivot([named(label)], [named(c) for c in columns], "column", "bin")
        .where(F.col("bin").isNotNull())
        .groupBy(named(label), "column", "bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
