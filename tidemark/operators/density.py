"""Densities of number columns per label, as violin plots draw them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import named
from tidemark.operators.quantiles import values
from tidemark.sources.storage import stored

# Grid points, and bandwidths that the grid reaches beyond the extremes.
POINTS = 100
CUT = 2.0


def density_by_label(
    df: DataFrame, label: str, columns: Sequence[str], points: int = POINTS, cut: float = CUT
) -> DataFrame:
    """``(label, column, point, x, density)``: a Gaussian kernel density on an even grid.

    The bandwidth is the group's sample deviation times n^(-1/5). Each value is shared
    out between the two grid points beside it, in proportion to nearness, so rows are reduced to ``points``
    weights a group by partial sums before the kernel is applied. Groups whose values do not vary
    have no density. ``df`` is read twice.
    """
    keys = [label, "column"]
    rows = values(df.where(named(label).isNotNull()), [label], columns)
    spread = F.stddev_samp("value")
    moments = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        (spread * F.pow(F.count(F.lit(1)).cast("double"), F.lit(-0.2))).alias("width"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
    )
    low, high = F.col("least") - cut * F.col("width"), F.col("most") + cut * F.col("width")
    grids = stored(
        moments.where("width > 0").select(
            *keys, "n", "width", low.alias("low"), ((high - low) / (points - 1)).alias("step")
        )
    )
    position = (F.col("value") - F.col("low")) / F.col("step")
    node = F.floor(position)
    weights = (
        rows.join(grids, keys)
        .withColumns({"node": node, "near": position - node})
        .select(
            *keys, "n", "width", "low", "step",
            F.inline(
                F.array(
                    F.struct(F.col("node").alias("node"), (1 - F.col("near")).alias("weight")),
                    F.struct((F.col("node") + 1).alias("node"), F.col("near").alias("weight")),
                )
            ),
        )
        .groupBy(*keys, "n", "width", "low", "step", "node")
        .agg(F.sum("weight").alias("weight"))
    )
    # As many weights as grid points.
    held = weights.groupBy(*keys, "n", "width", "low", "step").agg(
        F.array_sort(F.collect_list(F.struct("node", "weight"))).alias("weights")
    )

    def density(point: Column) -> Column:
        def share(total: Column, w: Column) -> Column:
            away = (point - w["node"]) * F.col("step") / F.col("width")
            return total + w["weight"] * F.exp(-0.5 * away * away)

        norm = F.col("n") * F.col("width") * F.sqrt(2 * F.pi())
        return F.aggregate("weights", F.lit(0.0), share) / norm

    grid = F.transform(
        F.sequence(F.lit(0), F.lit(points - 1)),
        lambda i: F.struct(i.alias("point"), (F.col("low") + i * F.col("step")).alias("x"), density(i).alias("density")),
    )
    return held.select(*keys, F.inline(grid))
