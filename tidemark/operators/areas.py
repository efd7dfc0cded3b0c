"""Areas under the ROC and precision-recall curves, exact, for any number of groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import named, unused

# Parts that a group's scores are cut into, and copies of the cuts that scores meet.
PARTS = 256
SALTS = 16


def _cuts(counts: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    """``(keys, cuts)``: an ordered sample of each group's scores, the ones of least hash.

    Which scores those are depends on nothing else, so that a recomputed part is the same part.
    """
    hashed = Window.partitionBy(*keys).orderBy(F.xxhash64("turned"), "turned")
    chosen = counts.select(*keys, "turned", F.row_number().over(hashed).alias("place")).where(F.col("place") < parts)
    return chosen.groupBy(*keys).agg(F.sort_array(F.collect_list("turned")).alias("cuts"))


def _cuts_below(parts: int) -> Column:
    """How many cuts lie below a score, by halving."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(parts.bit_length()))])

    def halve(at: Column, step: Column) -> Column:
        inside = (at + step <= F.size("cuts")) & (F.try_element_at("cuts", at + step) < F.col("turned"))
        return F.when(inside, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), halve)


def grouped_areas(
    df: DataFrame,
    groups: Sequence[str],
    label: str = "label",
    score: str = "rawPrediction",
    parts: int = PARTS,
) -> DataFrame:
    """``(groups, rows, areaUnderROC, areaUnderPR)`` from every distinct score of each group.

    ``label`` is 0 or 1. Scores are counted, and a group's counts cut into parts by a sample of
    its own scores; sums per part are carried from part to part, so a group that holds most rows is
    not sorted in one task. Lazy: nothing runs until the result is read. Rows without a label or score
    are left out; an area is NULL where a group lacks one of the classes.
    """
    keys = [unused([*df.columns, *groups], f"_g{i}") for i in range(len(groups))]
    rows = df.select(
        # A struct, so that a group of NULL joins as any other.
        *[F.struct(named(g).alias("g")).alias(k) for g, k in zip(groups, keys)],
        named(label).cast("double").alias("hit"),
        (-named(score).cast("double")).alias("turned"),
    ).where(F.col("hit").isNotNull() & F.col("turned").isNotNull() & ~F.isnan("turned"))
    counts = rows.groupBy(*keys, "turned").agg(
        F.sum("hit").alias("pos"), (F.count(F.lit(1)) - F.sum("hit")).alias("neg")
    )
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    cuts = _cuts(counts, keys, parts).select(*keys, "cuts", salts)
    salted = counts.withColumn("salt", F.pmod(F.xxhash64("turned"), F.lit(SALTS)).cast("int"))
    placed = salted.join(cuts, [*keys, "salt"]).select(*keys, "turned", "pos", "neg", _cuts_below(parts).alias("part"))
    carried = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    totals = placed.groupBy(*keys, "part").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))

    def before(name: str) -> Column:
        return F.coalesce(F.sum(name).over(carried), F.lit(0.0))

    starts = totals.select(
        *keys, "part", before("p").alias("p0"), before("n").alias("n0"), F.sum("p").over(whole).alias("p"), F.sum("n").over(whole).alias("n")
    )
    within = Window.partitionBy(*keys, "part").orderBy("turned").rowsBetween(Window.unboundedPreceding, -1)

    def inside(name: str) -> Column:
        return F.coalesce(F.sum(name).over(within), F.lit(0.0))

    summed = placed.withColumns({"pos0": inside("pos"), "neg0": inside("neg")}).join(starts, [*keys, "part"])
    hits, misses = F.col("p0") + F.col("pos0"), F.col("n0") + F.col("neg0")
    after_hits, after_misses = hits + F.col("pos"), misses + F.col("neg")
    precision = after_hits / (after_hits + after_misses)
    # The curve starts level with its first point.
    earlier = F.coalesce(F.try_divide(hits, hits + misses), precision)
    result = summed.groupBy(*keys).agg(
        F.sum(F.col("pos") + F.col("neg")).cast("bigint").alias("rows"),
        F.try_divide(F.sum(F.col("neg") * (hits + after_hits)) / 2, F.max("p") * F.max("n")).alias("areaUnderROC"),
        F.try_divide(F.sum(F.col("pos") * (precision + earlier)) / 2, F.max("p")).alias("areaUnderPR"),
    )
    return result.select(*[F.col(k)["g"].alias(g) for g, k in zip(groups, keys)], "rows", "areaUnderROC", "areaUnderPR")
