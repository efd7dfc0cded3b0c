"""Cross validation by statistics that subtract: one pass fits the model of every fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import named
from tidemark.sources.storage import stored

# Fixed value: share of the largest variance that is added to each, as MLlib does.
SMOOTHING = 1e-9


def gaussian_fold_models(df: DataFrame, features: str, width: int, label: str, fold: str) -> DataFrame:
    """``(fold, classes)``: the Gaussian Bayes model of each fold's training rows, all others.

    Counts, sums and sums of squares per fold and label come from one aggregate; those of a
    training part are the total less the fold. ``classes`` is an array of ``(label, log_n, means,
    variances)`` in order of label. Centre the features first where their means are large.
    """
    values = [named(features)[i] for i in range(width)]
    cells = df.groupBy(named(fold).alias("fold"), named(label).cast("double").alias("label")).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(x) for x in values]).alias("sums"),
        F.array(*[F.sum(x * x) for x in values]).alias("squares"),
    )
    cells = stored(cells)
    folds = cells.select("fold").distinct()
    totals = cells.groupBy("label").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums"),
        F.array(*[F.sum(F.col("squares")[i]) for i in range(width)]).alias("squares"),
    )
    # One row per fold and label: a fold may lack a label that the others have.
    every = totals.select(F.struct("label", "n", "sums", "squares").alias("all"), F.explode(_listed(folds)).alias("fold"))
    own = cells.select("fold", F.col("label"), F.struct("n", "sums", "squares").alias("own"))
    both = every.join(own, (every["fold"] == own["fold"]) & (F.col("all.label") == own["label"]), "left")

    def less(name: str) -> Column:
        taken = F.coalesce(F.col(f"own.{name}"), F.transform(f"all.{name}", lambda _: F.lit(0.0)))
        return F.zip_with(f"all.{name}", taken, lambda a, b: a - b)

    train = both.select(
        every["fold"],
        F.col("all.label").alias("label"),
        (F.col("all.n") - F.coalesce("own.n", F.lit(0))).alias("n"),
        less("sums").alias("sums"),
        less("squares").alias("squares"),
    ).where("n > 0")
    # The largest variance of any feature over a fold's training rows, whatever their label.
    part = Window.partitionBy("fold")
    spread = [
        F.sum(F.col("squares")[i]).over(part) / F.sum("n").over(part)
        - (F.sum(F.col("sums")[i]).over(part) / F.sum("n").over(part)) ** 2
        for i in range(width)
    ]
    train = train.withColumn("extra", F.array_max(F.array(*spread)) * SMOOTHING)
    means = F.transform("sums", lambda s: s / F.col("n"))
    variances = F.zip_with(
        "squares", "sums", lambda q, s: F.col("extra") + q / F.col("n") - (s / F.col("n")) * (s / F.col("n"))
    )
    entry = F.struct("label", F.log("n").alias("log_n"), means.alias("means"), variances.alias("variances"))
    return train.groupBy("fold").agg(F.array_sort(F.collect_list(entry)).alias("classes"))


def _listed(folds: DataFrame) -> Column:
    """All folds as one array; they are as few as the folds asked for."""
    return folds.agg(F.sort_array(F.collect_list("fold"))).scalar()


def gaussian_fold_scores(df: DataFrame, features: str, width: int, label: str, fold: str) -> DataFrame:
    """``(fold, rows, accuracy)`` of Gaussian Bayes, each fold scored by the model of the others.

    ``features`` is an array column of ``width`` numbers. Two passes, whatever the number of folds:
    one for the statistics, one to score.
    """
    fitted = stored(gaussian_fold_models(df, features, width, label, fold))
    scored = df.select(named(fold).alias("fold"), named(label).cast("double").alias("label"), named(features).alias("x"))

    def score(c: Column) -> Column:
        parts = F.zip_with(
            F.zip_with("x", c["means"], lambda x, m: (x - m) * (x - m)),
            c["variances"],
            lambda square, variance: square / variance + F.log(variance),
        )
        return c["log_n"] - F.aggregate(parts, F.lit(0.0), lambda a, p: a + p) / 2

    scores = F.transform("classes", lambda c: F.struct(score(c).alias("score"), (-c["label"]).alias("turned")))
    # Of equal scores the smaller label wins, as in MLlib.
    best = -F.array_max(scores)["turned"]
    return (
        scored.join(fitted, "fold")
        .groupBy("fold")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.avg((best == F.col("label")).cast("double")).alias("accuracy"),
        )
    )
