"""Exact quantiles and box statistics without holding or sorting a group.

The built-in exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer. Here a bounded sketch first brackets each wanted quantile between two values; a
pass of partial counts tells how many values lie below the bracket, and so which ranks it
holds; only values inside a bracket are then shuffled and sorted. The sketch decides how much
that is, not what is found: a bracket that misses its ranks is opened to all values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import named
from tidemark.sources.storage import stored

# A sketch's rank error is about one row in so many; its size grows with this, not with the rows.
ACCURACY = 50_000


def values(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows ``(keys, column, value)`` for every value that is neither NULL nor NaN."""
    pairs = [
        F.struct(F.lit(c).alias("column"), named(c).cast("double").alias("value")) for c in columns
    ]
    return df.select(*[named(k).alias(k) for k in keys], F.inline(F.array(*pairs))).where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def value_counts(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows ``(keys, column, value, n)``: how often each value occurs, gaps left out."""
    return values(df, keys, columns).groupBy(*[named(k) for k in keys], "column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def exact_quantiles(
    rows: DataFrame,
    keys: Sequence[str],
    probabilities: Sequence[float],
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Linear-interpolated quantiles of ``value`` for each group, as array ``quantiles``.

    ``rows`` holds ``keys`` without NULLs and a ``value`` that is neither NULL nor NaN, and may hold ``n``,
    how many rows each stands for. It is read three times. Of a
    group's rows about ``4 / accuracy`` are shuffled for each probability. The two small
    tables of brackets are written once, which fixes them and lets Spark see their size.
    """
    weight = F.col("n") if "n" in rows.columns else F.lit(1).cast("bigint")
    rows = rows.select(*keys, "value", weight.alias("n"))
    margin = 2 / accuracy
    lows = [max(0.0, p - margin) for p in probabilities]
    highs = [min(1.0, p + margin) for p in probabilities]
    cuts = stored(
        rows.groupBy(*keys).agg(
            F.percentile_approx("value", [*lows, *highs], accuracy).alias("cuts"),
            F.sum("n").alias("total"),
        )
    )
    places = range(len(probabilities))
    value = F.col("value")

    def low(i: int) -> Column:
        return F.col("cuts")[i]

    def high(i: int) -> Column:
        return F.col("cuts")[len(probabilities) + i]

    counted = rows.join(cuts, list(keys)).groupBy(*keys, "cuts", "total").agg(
        *[F.sum(F.when(value < low(i), F.col("n")).otherwise(0)).alias(f"below_{i}") for i in places],
        *[F.sum(F.when(value.between(low(i), high(i)), F.col("n")).otherwise(0)).alias(f"inside_{i}") for i in places],
    )

    def bracket(i: int) -> Column:
        position = F.lit(float(probabilities[i])) * (F.col("total") - 1)
        first, last = F.floor(position), F.ceil(position)
        below = F.col(f"below_{i}")
        holds = (below <= first) & (last < below + F.col(f"inside_{i}"))
        return F.struct(
            F.lit(i).alias("place"),
            F.when(holds, low(i)).otherwise(float("-inf")).alias("low"),
            F.when(holds, high(i)).otherwise(float("inf")).alias("high"),
            F.when(holds, below).otherwise(0).alias("below"),
            first.alias("first"),
            last.alias("last"),
            (position - first).alias("share"),
        )

    brackets = stored(counted.select(*keys, F.array(*[bracket(i) for i in places]).alias("brackets")))
    held = F.filter("brackets", lambda b: value.between(b["low"], b["high"]))
    # Each value of a bracket once, with how often it occurs.
    inside = (
        rows.join(brackets, list(keys))
        .select(*keys, "value", "n", F.explode(held).alias("b"))
        .groupBy(*keys, "b", "value")
        .agg(F.sum("n").alias("n"))
    )
    running = Window.partitionBy(*keys, "b.place").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.withColumn("next", F.col("b.below") + F.sum("n").over(running))

    def at(rank: str) -> Column:
        hit = (F.col(f"b.{rank}") >= F.col("next") - F.col("n")) & (F.col(f"b.{rank}") < F.col("next"))
        return F.max(F.when(hit, value))

    found = ranked.groupBy(*keys, F.col("b.place").alias("place"), F.col("b.share").alias("share")).agg(
        at("first").alias("low"), at("last").alias("high")
    )
    exact = F.col("low") + (F.col("high") - F.col("low")) * F.col("share")
    # Equal neighbours, also infinite ones, need no interpolation.
    exact = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(exact)
    ordered = F.array_sort(F.collect_list(F.struct("place", exact.alias("quantile"))))
    return found.groupBy(*keys).agg(F.transform(ordered, lambda x: x["quantile"]).alias("quantiles"))


def box_stats(
    df: DataFrame,
    label: str,
    columns: Sequence[str],
    exact: bool = True,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Quartiles, whiskers and outlier count of each column for each label value.

    Whiskers reach the last values within 1.5 quartile ranges of the box. Rows
    without a label are left out. With ``exact=False`` the quartiles come from a bounded sketch.
    ``df`` is read once for each pass (four, or two), so store it first if it is costly.
    """
    keys = [label, "column"]
    rows = values(df.where(named(label).isNotNull()), [label], columns)
    if exact:
        quartiles = exact_quantiles(rows, keys, (0.25, 0.5, 0.75), accuracy)
    else:
        quartiles = rows.groupBy(*keys).agg(
            F.percentile_approx("value", [0.25, 0.5, 0.75], accuracy).alias("quantiles")
        )
    box = stored(
        quartiles.select(
            *keys,
            F.col("quantiles")[0].alias("q1"),
            F.col("quantiles")[1].alias("median"),
            F.col("quantiles")[2].alias("q3"),
        )
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        rows.join(box, keys)
        .groupBy(*keys, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )
