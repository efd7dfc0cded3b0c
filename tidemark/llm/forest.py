"""Approximate nearest neighbours by a hash-prefix forest.

Each tree gives every vector a long string of hash bits (signs of random projections) and
keeps the vectors in the order of their strings. A query descends in every tree to its
longest prefix match; then all trees ascend together, one bit at a time, until the vectors
that share the query's prefix are enough candidates. Those are compared exactly.

How it is spread: a tree's sorted array is cut where the first ``depth`` bits change, and
large cuts further into blocks of ``BLOCK`` vectors, so every block is a task-sized sorted
array. First each block tells, for its queries, how many vectors share each prefix length;
summed over trees and blocks this gives the level at which a query stops. Then each block
compares the queries that stop at such a level with the vectors under their prefix, and
returns its best. A query that must ascend above ``depth`` bits visits all blocks there.
Blocks hold at most ``BLOCK`` vectors and meet at most ``BLOCK`` queries at a time, whatever
share of the rows one prefix has.

Equal vectors are one entry, which keeps the smallest ids that any query can need.
Vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part. Repeated ids with equal vectors count once. For inner products of vectors
that differ in length, entries get one more component that makes their lengths equal.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

TREES = 24
HASH_BITS = 48
# Candidates, counted in every tree they are found in: a share of the entries, and no fewer
# than so many for each neighbour asked for.
SHARE = 0.8
EACH = 64
NEIGHBOURS = 20
BLOCK = 8192
SEED = 17


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v)``: the vectors that take part; floats stay as they are, all else becomes double."""
    floats = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    v = F.col("embedding") if floats else F.col("embedding").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
    )
    return rows.where(~bad & F.exists("v", lambda x: x != 0))


def _hashes(width: int, trees: int, bits: int, seed: int) -> np.ndarray:
    # One more row for the component that equalises lengths.
    return np.random.default_rng(seed).standard_normal((width + 1, trees * bits)).astype(np.float32)


def _strings(x: np.ndarray, planes: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """Hash strings as numbers, first bit highest; one column per tree."""
    out = np.zeros((len(x), trees), dtype=np.int64)
    for t in range(trees):
        signs = (x @ planes[:, t * bits : (t + 1) * bits]) > 0
        for b in range(bits):
            out[:, t] = (out[:, t] << 1) | signs[:, b]
    return out


def neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = NEIGHBOURS,
    trees: int = TREES,
    bits: int = HASH_BITS,
    share: float = SHARE,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the nearest other rows of every row marked as a query."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    widths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if widths is None:
        return empty
    width = widths["n"]
    rows = stored(rows.where(F.size("v") == width).dropDuplicates(["vec_id", "v"]))
    # An entry for each distinct vector: no query needs more than k + 1 of its ids.
    ranked = rows.withColumn("at", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("at") <= k + 1)
    entries = ranked.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    entries = stored(entries.select("v", "ids", F.col("ids")[0].alias("entry"), norm.alias("norm")))
    asked = stored(rows.where(is_query).join(entries.select("v", "entry"), "v").select(F.col("vec_id").alias("query_id"), "entry"))
    n, longest = entries.agg(F.count(F.lit(1)), F.max("norm")).first()
    wanted = max(EACH * k, ceil(share * n))
    # Cut two levels above where queries stop on average; those that go higher visit several cuts.
    depth = min(bits, max(0, int(log2(max(1.0, trees * n / wanted))) - 2))

    planes = spark.sparkContext.broadcast(pickle.dumps(_hashes(width, trees, bits, seed)))

    def hashed(frame: DataFrame, query: bool) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            normals = pickle.loads(planes.value)
            for rows in batches:
                if not len(rows):
                    continue
                x = np.stack(rows["v"].to_numpy()).astype(float)
                length = rows["norm"].to_numpy()
                rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(longest**2 - length**2, 0))
                strings = _strings(np.column_stack((x, rest)).astype(np.float32), normals, trees, bits)
                kept = rows[["entry", "v"]] if query else rows[["entry", "ids", "v"]]
                yield kept.assign(strings=list(strings))

        v = f"v {entries.schema['v'].dataType.simpleString()}"
        kinds = f"entry long, {v}" if query else f"entry long, ids array<long>, {v}"
        made = frame.mapInPandas(run, f"{kinds}, strings array<long>")
        return made.select("*", F.posexplode("strings").alias("tree", "string")).drop("strings")

    cut = F.shiftright("string", bits - depth) if depth else F.lit(0).cast("long")
    points = stored(hashed(entries, False).withColumn("cut", cut))
    seekers = asked.select("entry").distinct().join(entries.select("entry", "v", "norm"), "entry")
    seekers = stored(hashed(seekers, True).withColumn("cut", cut))
    sizes = points.groupBy("tree", "cut").count()
    sizes = stored(sizes.withColumn("blocks", F.ceil(F.col("count") / block).cast("int")))
    places = (
        points.join(sizes.select("tree", "cut", "blocks"), ["tree", "cut"])
        .withColumn("block", F.pmod(F.xxhash64("entry"), "blocks").cast("int"))
        .drop("blocks")
    )

    # Levels up to the cuts are counted from the cuts' sizes, deeper ones in the blocks.
    strings = places.select("tree", "cut", "block", "string")
    deeper = _meet(strings, seekers, sizes, block, lambda p, q: _counts(p, q, bits, depth), "entry long, level int, n long", [])
    above = _counts_above(seekers, sizes, depth)
    found = deeper.unionByName(above).groupBy("entry", "level").agg(F.sum("n").alias("n"))
    stops = found.where(F.col("n") >= wanted).groupBy("entry").agg(F.max("level").alias("level"))
    stops = stored(seekers.select("entry").distinct().join(stops, "entry", "left").select("entry", F.coalesce("level", F.lit(0)).alias("level")))

    visiting = seekers.join(stops, "entry")
    low = visiting.where(F.col("level") < depth)
    # All cuts under a prefix shorter than the cuts' own.
    span = F.lit(depth) - F.col("level")
    under = F.expr("sequence(shiftleft(shiftright(cut, span), span), shiftleft(shiftright(cut, span) + 1, span) - 1)")
    low = low.withColumn("span", span).withColumn("cut", F.explode(under)).drop("span")
    visiting = visiting.where(F.col("level") >= depth).unionByName(low.select(visiting.columns))
    near = _meet(
        places, visiting, sizes, block, lambda p, q: _nearest(p, q, bits, k + 1), "entry long, found array<struct<id:long,score:double>>", ["v", "level"]
    )
    # A block returns k + 1 ids a query at most; the best of all blocks and trees are taken per query.
    pairs = near.select("entry", F.explode("found").alias("f")).select("entry", F.col("f.id").alias("vec_id"), F.col("f.score").alias("score"))
    pairs = pairs.groupBy("entry", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("entry").orderBy(F.desc("score"), "vec_id")
    best = stored(pairs.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1).drop("at"))
    answers = asked.join(best, "entry").where(F.col("query_id") != F.col("vec_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    answers = answers.withColumn("rank", rank).where(F.col("rank") <= k)
    return answers.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _meet(places: DataFrame, seekers: DataFrame, sizes: DataFrame, block: int, work, schema: str, extra: list[str]) -> DataFrame:
    """``work(points, queries)`` for every block and each part of the queries that visit it."""
    asking = seekers.groupBy("tree", "cut").count().select(
        "tree", "cut", F.ceil(F.col("count") / block).cast("int").alias("parts")
    )
    key = ["tree", "cut", "block", "part"]
    at = seekers.join(sizes.select("tree", "cut", "blocks"), ["tree", "cut"]).join(asking, ["tree", "cut"])
    at = at.select(
        "tree", "cut", "entry", "string", *extra,
        F.pmod(F.xxhash64("entry", F.lit(1)), "parts").cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
    )
    held = places.join(asking, ["tree", "cut"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def run(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        return work(p, q)

    return held.groupBy(*key).cogroup(at.groupBy(*key)).applyInPandas(run, schema)


def _counts_above(seekers: DataFrame, sizes: DataFrame, depth: int) -> DataFrame:
    """How many entries share the first bits, for levels that end above the cuts."""
    out = None
    for level in range(depth):
        up = F.shiftright("cut", depth - level)
        sums = sizes.groupBy("tree", up.alias("up")).agg(F.sum("count").alias("n"))
        part = seekers.select("entry", "tree", up.alias("up")).join(sums, ["tree", "up"])
        part = part.select("entry", F.lit(level).alias("level"), "n")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else seekers.select("entry", F.lit(0).alias("level"), F.lit(0).cast("long").alias("n")).limit(0)


def _ranges(p: np.ndarray, q: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    prefix = p >> shift
    return np.searchsorted(prefix, q >> shift, "left"), np.searchsorted(prefix, q >> shift, "right")


def _counts(p: pd.DataFrame, q: pd.DataFrame, bits: int, depth: int) -> pd.DataFrame:
    """Vectors that share each prefix, from the cut's bits on, while there are any."""
    strings = np.sort(p["string"].to_numpy(dtype=np.int64))
    asked, ids = q["string"].to_numpy(dtype=np.int64), q["entry"].to_numpy()
    out = []
    for level in range(depth, bits + 1):
        a, b = _ranges(strings, asked, bits - level)
        some = b > a
        if not some.any():
            break
        out.append(pd.DataFrame({"entry": ids[some], "level": level, "n": (b - a)[some]}))
    return pd.concat(out) if out else pd.DataFrame({"entry": [], "level": [], "n": []})


def _nearest(p: pd.DataFrame, q: pd.DataFrame, bits: int, k: int) -> pd.DataFrame:
    """The best ids under each query's prefix, with exact scores."""
    if not len(p) or not len(q):
        return pd.DataFrame({"entry": [], "found": []})
    p = p.sort_values(["string", "entry"])
    x, strings, ids = np.stack(p["v"].to_numpy()).astype(float), p["string"].to_numpy(dtype=np.int64), p["ids"].to_numpy()
    out = []
    for level, rows in q.groupby("level"):
        asked = rows["string"].to_numpy(dtype=np.int64)
        a, b = _ranges(strings, asked, bits - int(level))
        # Queries with one prefix share one product of matrices.
        for (lo, hi), at in pd.DataFrame({"a": a, "b": b}).groupby(["a", "b"]).groups.items():
            if hi <= lo:
                continue
            some = rows.iloc[at]
            scores = np.stack(some["v"].to_numpy()).astype(float) @ x[lo:hi].T
            top = min(k, hi - lo)
            for entry, line in zip(some["entry"], scores):
                # All that tie with the last one stay, so that ties go to smaller ids.
                edge = np.partition(line, len(line) - top)[len(line) - top]
                best = np.flatnonzero(line >= edge)
                pairs = [(i, s) for c, s in zip(best, line[best]) for i in ids[lo + c]]
                pairs.sort(key=lambda t: (-t[1], t[0]))
                out.append((entry, [{"id": int(i), "score": float(s)} for i, s in pairs[:k]]))
    return pd.DataFrame(out, columns=["entry", "found"])
