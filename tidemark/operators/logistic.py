"""Logistic regression on sparse features, whose weights stay a table.

MLlib holds a model's weights, and some twenty vectors as long, on the driver. Here the weights of
each wide category lie in a table of one row per value. A row of data has at most one value of a
category, so the second derivatives among a category's weights are a diagonal: a Newton step of all
of them together with the few narrow slots (intercept, numbers, small categories) takes sums per
value and one system as large as there are narrow slots. Only that system is on the driver.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import named, unused
from tidemark.operators.sparse import SLOTS, InputColumn, SparseFeatures
from tidemark.sources.storage import stored

logger = logging.getLogger(__name__)

#: A category of more values than this is wide.
NARROW = 16
WEIGHTS = "slot int, weight double"
#: Rows without a value of the wide category are dealt to so many groups, numbered below 0.
SPREAD = 1024


def _split(fitted: SparseFeatures, narrow: int) -> tuple[list[int], list[InputColumn]]:
    """Slots of the narrow columns, and the wide categories."""
    wide = [c for c in fitted.columns if c.categorical and c.slots > narrow]
    return [c.start + i for c in fitted.columns if c not in wide for i in range(c.slots)], wide


def _value(slots: Column, slot: int) -> Column:
    """The row's entry in one slot, 0 if it has none."""
    found = F.filter(slots, lambda s: s["slot"] == slot)
    return F.coalesce(F.get(found, F.lit(0))["value"], F.lit(0.0))


def _slot_in(slots: Column, column: InputColumn) -> Column:
    """The row's slot of a category, NULL if it has none."""
    inside = F.filter(slots, lambda s: (s["slot"] >= column.start) & (s["slot"] < column.start + column.slots))
    return F.get(inside, F.lit(0))["slot"]


def _dot(weights: Sequence[float], numbers: Sequence[Column]) -> Column:
    return sum((F.lit(float(w)) * x for w, x in zip(weights, numbers, strict=True)), F.lit(0.0))


def _probability(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


@dataclass
class _Block:
    """Weights of one wide category: a table ``(k, weight, step)``, of which ``share`` of the step is taken."""

    table: DataFrame
    share: float = 1.0

    def current(self) -> DataFrame:
        return self.table.select("k", (F.col("weight") + self.share * F.col("step")).alias("w"))


def fit_logistic(
    rows: DataFrame,
    fitted: SparseFeatures,
    path: str,
    reg_param: float,
    tol: float = 1e-8,
    max_iter: int = 100,
    narrow: int = NARROW,
    label: str = "label",
) -> LogisticTable:
    """Fit on prepared ``rows`` and save below ``path``: mean log loss and ``reg_param`` / 2 of the weights' squares.

    The intercept bears no penalty. Wide categories take Newton steps in turn; an overlong step is
    halved. The fit ends when no part of the gradient exceeds ``tol``. Each step reads the rows
    once and shuffles them once for each wide category. The sums per value are as many as pairs
    of narrow slots.
    """
    if reg_param <= 0:
        raise ValueError("values that go with one label only have no finite weights without a penalty")
    spark = rows.sparkSession
    slots, wide = _split(fitted, narrow)
    entries = fitted.slots(rows)
    numbers = [F.lit(1.0), *[F.col(f"x{i}") for i in range(len(slots))]]
    # A NULL would bring all such rows to one task of the joins.
    spread = -1 - F.pmod(F.xxhash64(*[named(c) for c in rows.columns]), F.lit(SPREAD)).cast("int")
    data = stored(
        entries.select(
            named(label).cast("double").alias("y"),
            *[_value(named(SLOTS), s).alias(f"x{i}") for i, s in enumerate(slots)],
            *[F.coalesce(_slot_in(named(SLOTS), c), spread).alias(f"k{i}") for i, c in enumerate(wide)],
        )
    )
    binary = F.coalesce(F.col("y").isin(0.0, 1.0), F.lit(False))
    n, labelled = data.agg(F.count(F.lit(1)), F.count_if(binary)).first()
    if not n or labelled < n:
        raise ValueError(f"{n - labelled} of {n} rows have another label than 0 or 1")
    penalty = reg_param * n
    ridge = np.array([0.0, *[penalty] * len(slots)])
    empty = spark.createDataFrame([], "k int, weight double, step double")
    blocks = [_Block(empty) for _ in wide]
    beta, move, share = np.zeros(len(numbers)), np.zeros(len(numbers)), 1.0
    stepped, open_step, best, turn, quiet = None, False, float("inf"), 0, 0
    for _ in range(max_iter):
        here, at = turn % max(1, len(wide)), beta + share * move
        sums = _sums(data, blocks, here, at, numbers, penalty).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            total = _totals(sums, len(numbers))
            objective = total["loss"] + float(ridge @ at**2) / 2 + penalty / 2 * _squares(blocks)
            if not np.isfinite(objective):
                raise ValueError("a number or the loss is not finite")
            if objective > best + 1e-11 * abs(best) and share > 1e-6:
                share /= 2
                if stepped is not None:
                    blocks[stepped].share = share
                continue
            best, beta, move, share, open_step = objective, at, np.zeros(len(numbers)), 1.0, False
            gradient = total["g"] + ridge * beta
            if max(np.abs(gradient).max(), total["steepest"]) <= tol * n:
                quiet, turn = quiet + 1, turn + 1
                if quiet >= len(wide):
                    break
                continue
            quiet, turn, open_step = 0, turn + 1, True
            # The wide slots eliminated, a system of the narrow ones is left.
            left = total["h"] + np.diag(ridge) - total["coupled"]
            move = np.linalg.lstsq(left, total["pulled"] - gradient, rcond=None)[0]
            if wide:
                away = F.col("g") + _dot(move, [F.col(f"h0_{i}") for i in range(len(numbers))])
                steps = sums.where("k >= 0").select("k", F.col("w").alias("weight"), (-away / F.col("hk")).alias("step"))
                blocks[here], stepped = _Block(stored(steps)), here
        finally:
            sums.unpersist()
    else:
        logger.warning("no optimum after %d steps", max_iter)
        if open_step and stepped is not None:
            # The last step was not judged, and the narrow slots have not taken it either.
            blocks[stepped].share = 0.0
    narrow_weights = [(-1, float(beta[0]))] + [(s, float(b)) for s, b in zip(slots, beta[1:], strict=True)]
    weights = spark.createDataFrame(narrow_weights, WEIGHTS)
    for column, block in zip(wide, blocks, strict=True):
        every = spark.range(column.start, column.start + column.slots).select(F.col("id").cast("int").alias("slot"))
        known = block.current().withColumnRenamed("k", "slot")
        weights = weights.unionByName(every.join(known, "slot", "left").select("slot", F.coalesce("w", F.lit(0.0)).alias("weight")))
    weights.write.mode("overwrite").parquet(f"{path}/weights")
    # The last to be written: a fit without it is not complete.
    record = spark.createDataFrame([(float(reg_param), narrow)], "reg_param double, narrow int")
    record.coalesce(1).write.mode("overwrite").parquet(f"{path}/record")
    return load_logistic(spark, fitted, path)


def _sums(
    data: DataFrame, blocks: Sequence[_Block], here: int, beta: np.ndarray, numbers: Sequence[Column], penalty: float
) -> DataFrame:
    """Loss and first and second derivatives for each value ``k`` of the category ``here``.

    ``r<i>`` are the narrow slots' gradients, ``h<i>_<j>`` their second derivatives; the first of them is the intercept.
    """
    margin = _dot(beta, numbers)
    # The category summed by is joined last, so that its join has dealt out the rows for the sums.
    for i in sorted(range(len(blocks)), key=lambda i: i == here):
        weight = blocks[i].current().select(F.col("k").alias(f"k{i}"), F.col("w").alias(f"w{i}"))
        data = data.join(weight, f"k{i}", "left")
        margin = margin + F.coalesce(f"w{i}", F.lit(0.0))
    key = F.col(f"k{here}") if blocks else F.lit(-1)
    own = F.coalesce(F.col(f"w{here}"), F.lit(0.0)) if blocks else F.lit(0.0)
    scored = data.select(key.alias("k"), own.alias("w"), "y", *numbers[1:], margin.alias("m"))
    scored = scored.withColumn("p", _probability(F.col("m")))
    residual, curve = F.col("p") - F.col("y"), F.col("p") * (1 - F.col("p"))
    loss = F.log1p(F.exp(-F.abs("m"))) + F.greatest(F.col("m"), F.lit(0.0)) - F.col("y") * F.col("m")
    pairs = [(i, j) for i in range(len(numbers)) for j in range(i, len(numbers))]
    sums = scored.groupBy("k").agg(
        F.max("w").alias("w"),
        F.sum(loss).alias("loss"),
        *[F.sum(residual * x).alias(f"r{i}") for i, x in enumerate(numbers)],
        *[F.sum(curve * numbers[i] * numbers[j]).alias(f"h{i}_{j}") for i, j in pairs],
    )
    return sums.withColumns({"g": F.col("r0") + penalty * F.col("w"), "hk": F.col("h0_0") + penalty})


def _totals(sums: DataFrame, width: int) -> dict:
    """What the narrow slots' system needs, in one row."""
    real = F.col("k") >= 0
    pairs = [(i, j) for i in range(width) for j in range(i, width)]

    def over(number: Column) -> Column:
        return F.coalesce(F.sum(F.when(real, number / F.col("hk"))), F.lit(0.0))

    cross = [F.col(f"h0_{i}") for i in range(width)]
    found = sums.agg(
        F.sum("loss"),
        F.coalesce(F.max(F.when(real, F.abs("g"))), F.lit(0.0)),
        *[F.sum(f"r{i}") for i in range(width)],
        *[over(cross[i] * F.col("g")) for i in range(width)],
        *[F.sum(f"h{i}_{j}") for i, j in pairs],
        *[over(cross[i] * cross[j]) for i, j in pairs],
    ).first()
    values = np.array(found, dtype=float)

    def matrix(entries: np.ndarray) -> np.ndarray:
        square = np.zeros((width, width))
        for (i, j), v in zip(pairs, entries, strict=True):
            square[i, j] = square[j, i] = v
        return square

    g, pulled, h, coupled = np.split(values[2:], np.cumsum([width, width, len(pairs)]))
    return {"loss": values[0], "steepest": values[1], "g": g, "pulled": pulled, "h": matrix(h), "coupled": matrix(coupled)}


def _squares(blocks: Sequence[_Block]) -> float:
    """Sum of all wide weights' squares."""
    found = [b.current().agg(F.coalesce(F.sum(F.col("w") * F.col("w")), F.lit(0.0))).first()[0] for b in blocks]
    return sum(found)


@dataclass(frozen=True)
class LogisticTable:
    """A fitted model: weights below ``path``, the narrow ones also here by slot; slot -1 is the intercept."""

    features: SparseFeatures
    path: str
    reg_param: float
    narrow: int
    near: tuple[tuple[int, float], ...]

    def weights(self, spark: SparkSession) -> DataFrame:
        """``(slot, weight)`` of every slot."""
        return spark.read.schema(WEIGHTS).parquet(f"{self.path}/weights")

    def transform(self, df: DataFrame) -> DataFrame:
        """Scored rows, with ``slots`` and the columns of MLlib's classifiers.

        A wide category's weights reach the rows by a join, as its index does.
        """
        scored = self.features.slots(df)
        slots, wide = _split(self.features, self.narrow)
        near = dict(self.near)
        margin = F.lit(near[-1]) + _dot([near[s] for s in slots], [_value(named(SLOTS), s) for s in slots])
        kept = scored.columns
        for i, column in enumerate(wide):
            slot, weight = unused(df.columns, f"_slot{i}"), unused(df.columns, f"_weight{i}")
            inside = F.col("slot").between(column.start, column.start + column.slots - 1)
            weights = self.weights(df.sparkSession).where(inside)
            weights = weights.select(F.col("slot").alias(f"{slot}w"), F.col("weight").alias(weight))
            scored = scored.withColumn(slot, _slot_in(named(SLOTS), column))
            scored = scored.join(weights, named(slot) == named(f"{slot}w"), "left")
            margin = margin + F.coalesce(named(weight), F.lit(0.0))
        probability = _probability(margin)
        return scored.select(
            *[named(c) for c in kept],
            array_to_vector(F.array(-margin, margin)).alias("rawPrediction"),
            array_to_vector(F.array(1 - probability, probability)).alias("probability"),
            F.when(margin > 0, 1.0).otherwise(0.0).alias("prediction"),
        )


def load_logistic(spark: SparkSession, fitted: SparseFeatures, path: str) -> LogisticTable:
    """A fitted model that was saved below ``path``."""
    record = spark.read.schema("reg_param double, narrow int").parquet(f"{path}/record").first()
    slots, _ = _split(fitted, record["narrow"])
    found = spark.read.schema(WEIGHTS).parquet(f"{path}/weights").where(F.col("slot").isin([-1, *slots])).collect()
    near = tuple(sorted((r["slot"], r["weight"]) for r in found))
    return LogisticTable(fitted, path, record["reg_param"], record["narrow"], near)
