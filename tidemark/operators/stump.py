"""Exact splits of a depth-1 tree from grouped counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import named


def _gini(rows: Column, hits: Column) -> Column:
    share = hits / rows
    return 2 * share * (1 - share)


def split_gains(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """``(column, threshold, left_rows, right_rows, gain)``: the Gini gain of every split of every column.

    A split sends values up to a threshold to the left; thresholds lie midway between neighbouring
    values. ``label`` is 0 or 1. Rows with a gap in any of the columns are left out. One shuffle of counts
    per (column, value), then running sums over a column's values, which should be few.
    """
    rows = df.select(named(label).cast("double").alias("hit"), *[named(c).cast("double").alias(c) for c in columns])
    rows = rows.dropna()
    counts = (
        rows.unpivot(["hit"], [named(c) for c in columns], "column", "value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("hit").alias("hits"))
    )
    order = Window.partitionBy("column").orderBy("value")
    so_far, all_rows = order.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("column")
    summed = counts.select(
        "column",
        ((F.col("value") + F.lead("value").over(order)) / 2).alias("threshold"),
        F.sum("n").over(so_far).alias("left_rows"),
        F.sum("hits").over(so_far).alias("left_hits"),
        F.sum("n").over(all_rows).alias("rows"),
        F.sum("hits").over(all_rows).alias("hits"),
    ).where("threshold IS NOT NULL")
    left, right = F.col("left_rows"), F.col("rows") - F.col("left_rows")
    children = left * _gini(left, F.col("left_hits")) + right * _gini(right, F.col("hits") - F.col("left_hits"))
    gain = _gini(F.col("rows"), F.col("hits")) - children / F.col("rows")
    return summed.select("column", "threshold", "left_rows", right.alias("right_rows"), gain.alias("gain"))


def best_split(gains: DataFrame) -> DataFrame:
    """The split of the greatest gain; of equal ones the first column, then the least threshold."""
    return gains.orderBy(F.desc("gain"), "column", "threshold").limit(1)
