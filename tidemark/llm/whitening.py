"""Whitening of embeddings onto their principal components.

Entries become whole numbers, so that sums are exact. Two passes over all vectors
give the exact mean and the covariance, centred before it is multiplied; the components are
eigenvectors found by contour integration (``feast``) in a matrix of dimensions only. A third
pass measures the covariance of what was whitened, a last one returns the rows. Each pass is
one map over the vectors and a sum of one small matrix per task, added up in two levels; nothing
grows with the rows but the result. The vectors are read four times, so a costly input should be stored first.

Vectors that are null or hold null or non-finite entries take no part, nor do those of another
length than most (of equally frequent lengths the longest). Entries beyond 2^40 once scaled are held there.
Components whose variance rounding cannot tell from 0 are left out; so a single vector, or equal vectors, give no
rows. ``deviation`` is null where it passes a long. Rows with equal or null ids are vectors of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.feast import largest_eigenpairs

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
BOUND = 1 << 40
# Tasks whose matrices are added in the first level of a sum; values of one column of the result at a time.
LEVEL = 64
ROWS = 4096


def usable(vector: Column) -> Column:
    """True where a vector is there and all its entries are finite."""
    value = vector.cast("array<double>")
    low, high = float("-inf"), float("inf")
    finite = F.forall(value, lambda x: F.coalesce(~F.isnan(x) & (x > low) & (x < high), F.lit(False)))
    return F.coalesce(finite, F.lit(False))


def whole_numbers(batch: pa.RecordBatch) -> np.ndarray:
    """The batch's vectors as whole numbers, one row each."""
    vectors = batch.column("vector")
    values = vectors.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    return np.floor(np.clip(values * SCALE, -BOUND, BOUND)).astype(np.int64) + OFFSET


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


@dataclass
class Fit:
    """What the passes have found: rows, sums, components as columns, their variances, the whole variance."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """Whole part and fraction of each mean."""
        whole = [s // self.n for s in self.sums]
        rest = [(s - w * self.n) / self.n for s, w in zip(self.sums, whole)]
        return np.array(whole, dtype=np.int64), np.array(rest)

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole, rest = self.centre()
        return (x - whole).astype(float) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2; through Python's integers only where a long might not do."""
        whole, rest = self.centre()
        far = self.n * (float(np.abs(x - whole).max(initial=0)) + 1)
        if far * far * x.shape[1] < 2**62:
            part = np.array([s - int(w) * self.n for s, w in zip(self.sums, whole)], dtype=np.int64)
            return ((self.n * (x - whole) - part) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * a - s) ** 2 for a, s in zip(row, self.sums)) for row in x.tolist()]
        return [d if d < 2**63 else None for d in exact]


def _summed(points: DataFrame, make: Callable[[np.ndarray], np.ndarray], rows: int) -> np.ndarray:
    """The sum over all vectors of the matrices that ``make(x)`` gives for portions of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in _portions(batches):
            made = make(whole_numbers(batch))
            total = made if total is None else total + made
        if total is not None:
            yield pa.record_batch(
                [
                    pa.array(np.arange(len(total), dtype=np.int32)),
                    pa.array(np.full(len(total), TaskContext.get().partitionId(), dtype=np.int32)),
                    pa.array(list(total), pa.list_(pa.float64())),
                ],
                ["i", "task", "row"],
            )

    def add(group: pd.DataFrame) -> pd.DataFrame:
        # In order of task, so that a rerun adds the same way.
        group = group.sort_values("task")
        return pd.DataFrame({"i": [group["i"].iloc[0]], "task": [group["task"].iloc[0]], "row": [np.sum(np.stack(group["row"]), axis=0)]})

    schema = "i int, task int, row array<double>"
    sums = points.mapInArrow(run, schema)
    sums = sums.groupBy("i", (F.col("task") / LEVEL).cast("int")).applyInPandas(lambda _, g: add(g), schema)
    found = sums.groupBy("i").applyInPandas(add, schema).collect()
    out = np.zeros((rows, rows))
    for r in found:
        out[r["i"]] = r["row"]
    return out


def _counted(points: DataFrame) -> tuple[int, list[int]]:
    """Rows and exact sums of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in _portions(batches):
            # A portion's sums fit a long; their sum may not.
            sums = whole_numbers(batch).sum(axis=0).tolist()
            total = sums if total is None else [a + b for a, b in zip(total, sums)]
            n += batch.num_rows
        if total is not None:
            yield pa.record_batch(
                [pa.array([n] * len(total)), pa.array(range(len(total)), pa.int32()), pa.array([str(t) for t in total])],
                ["n", "i", "total"],
            )

    sums = points.mapInArrow(run, "n long, i int, total string")
    found = sums.groupBy("i").agg(F.sum("n"), F.sum(F.col("total").cast("decimal(38)"))).orderBy("i").collect()
    return (int(found[0][1]), [int(r[2]) for r in found]) if found else (0, [])


def fit(points: DataFrame, components: int) -> Fit:
    """Mean and components of ``points (vector)``, all of one length."""
    n, sums = _counted(points)
    found = Fit(n, sums, np.empty((len(sums), 0)), np.empty(0), 0.0)
    if n:
        def scatter(x: np.ndarray) -> np.ndarray:
            c = found.centred(x)
            return c.T @ c

        covariance = _summed(points, scatter, len(sums)) / n
        covariance = (covariance + covariance.T) / 2
        found.values, found.vectors = largest_eigenpairs(covariance, components)
        found.trace = float(np.trace(covariance))
    return found


def _identity_error(points: DataFrame, fitted: Fit) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity."""
    size = len(fitted.values)

    def moments(x: np.ndarray) -> np.ndarray:
        # A column of ones beside the vectors gives their sums as well.
        w = np.concatenate((fitted.whitened(x), np.ones((len(x), 1))), axis=1)
        return w.T @ w

    both = _summed(points, moments, size + 1) / fitted.n
    mean = both[size, :size]
    return float(np.abs(both[:size, :size] - np.outer(mean, mean) - np.eye(size)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector of ``vectors (vec_id, embedding)`` and component.

    ``(vec_id, component, n, deviation, whitened, explained, identity_error)``; components are
    numbered from 1 by falling variance, ``explained`` is their share of it.
    """
    points = vectors.where(usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    lengths = points.groupBy(F.size("vector").alias("d")).count()
    most = lengths.where("d > 0").orderBy(F.desc("count"), F.desc("d")).first()
    if most is None:
        return vectors.sparkSession.createDataFrame([], schema)
    points = points.where(F.size("vector") == most["d"])
    fitted = fit(points, components)
    size = len(fitted.values)
    if not size:
        return vectors.sparkSession.createDataFrame([], schema)
    error = _identity_error(points, fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            x = whole_numbers(batch)
            rows = len(x)
            each = np.repeat(np.arange(rows), size)
            yield pa.record_batch(
                [
                    batch.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * size, fitted.n)),
                    pa.array(fitted.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(fitted.whitened(x).ravel()),
                    pa.array(np.tile(fitted.values / fitted.trace, rows)),
                    pa.array(np.full(rows * size, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return points.mapInArrow(run, schema)
