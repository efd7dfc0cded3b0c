"""Benchmark decontamination by winnowing.

Every window of ten words holds six 5-grams; its fingerprint is their least hash.
Training and benchmark texts that share a window share that fingerprint, so joining the
fingerprints finds each document with a shared window. What they bring up is extended:
the document's windows around it are compared with the items' windows, word by word.
Items with fewer than ten words are one window; for them each gram of that length is
a fingerprint (a winnowing window of one).

Everything on the main path is DataFrame operations. Null and empty texts have no words
and are clean; rows that repeat id and text each get the same result. Items with equal
ids count once in the list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import plain_words, stored

WINDOW = 10
GRAM = 5

KEY = ["doc_id", "text_hash"]


def _grams(words: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words; empty if there are too few."""
    starts = F.sequence(F.lit(1), F.size(words) - (size - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, size)))
    return F.when(F.size(words) >= size, hashes).otherwise(F.array().cast("array<bigint>"))


def fingerprints(words: Column, window: int, gram: int) -> Column:
    """The distinct least hashes of all runs of ``window`` words."""
    width = window - gram + 1
    hashes = _grams(words, gram)
    # The lambda sees one computed array, not an expression to repeat for each window.
    least = F.transform(
        F.array(hashes),
        lambda h: F.when(
            F.size(h) >= width,
            F.array_distinct(
                F.transform(F.sequence(F.lit(1), F.size(h) - (width - 1)), lambda i: F.array_min(F.slice(h, i, width)))
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    return least[0]


def _windows(words: Column, size: int) -> Column:
    """Structs of start and words of all windows of ``size`` words."""
    starts = F.sequence(F.lit(1), F.size(words) - (size - 1))
    found = F.transform(
        starts, lambda i: F.struct((i - 1).alias("start"), F.slice(words, i, size).alias("window"))
    )
    return F.when(F.size(words) >= size, found)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``(doc_id, text_hash, n_words, n_hit, items)`` for every row of ``docs (doc_id, text)``."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    items = stored(
        benchmark.select("item_id", plain_words(F.col("text")).alias("words"))
        .where(F.size("words") > 0)
        .withColumn("size", F.least(F.size("words"), F.lit(window)))
    )
    # At most `window` values, whatever the benchmark's size.
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())

    def prints(words: Column, size: int) -> Column:
        return fingerprints(words, size, gram if size == window else size)

    marks = [
        items.where(F.col("size") == n).select(F.lit(n).alias("size"), F.explode(prints(F.col("words"), n)).alias("print"))
        for n in sizes
    ]
    targets = [
        items.where(F.col("size") == n)
        .select("item_id", F.lit(n).alias("size"), F.explode(_windows(F.col("words"), n)).alias("w"))
        .select("item_id", "size", F.col("w.window").alias("window"))
        .distinct()
        for n in sizes
    ]
    # Words are computed once per text, as the one element of an array.
    words = plain_words(F.col("text"))
    taken = F.transform(
        F.array(words),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), *[prints(w, n).alias(f"p{n}") for n in sizes]
        ),
    )[0]
    base = stored(texts.select(*KEY, taken.alias("t")).select(*KEY, "t.*"))
    counts = base.select(*KEY, "n_words")
    if not sizes:
        return counts.select(*KEY, "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))

    met = None
    for n, mark in zip(sizes, marks):
        mark = stored(mark.select("print").distinct())
        found = base.select(*KEY, F.explode(f"p{n}").alias("print")).join(mark, "print").select(*KEY)
        met = found if met is None else met.unionByName(found)
    met = stored(met.distinct())
    targets = [stored(t) for t in targets]

    near = stored(
        texts.join(met.withColumnRenamed("doc_id", "met_id").withColumnRenamed("text_hash", "met_hash"),
                   F.col("doc_id").eqNullSafe(F.col("met_id")) & F.col("text_hash").eqNullSafe(F.col("met_hash")))
        .select(*KEY, plain_words(F.col("text")).alias("words"))
        .dropDuplicates(KEY)
    )
    spans, owners = None, None
    for n, target in zip(sizes, targets):
        windows = near.select(*KEY, F.explode(_windows(F.col("words"), n)).alias("w")).select(
            *KEY, F.col("w.start").alias("start"), F.col("w.window").alias("window")
        )
        hit = stored(windows.join(target.select("window").distinct(), "window"))
        span = hit.select(*KEY, "start", (F.col("start") + n).alias("end"))
        owner = hit.select(*KEY, "window").distinct().join(target, "window").select(*KEY, "item_id")
        spans = span if spans is None else spans.unionByName(span)
        owners = owner if owners is None else owners.unionByName(owner)
    # Length of the union of a text's spans; there are no more of them than words.
    covered = F.aggregate(
        F.array_sort(F.collect_list(F.struct("start", "end"))),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["end"]))).cast("long").alias("n"),
            F.greatest(a["end"], s["end"]).alias("end"),
        ),
        lambda a: a["n"],
    )
    hits = spans.groupBy(*KEY).agg(covered.alias("n_hit"))
    names = owners.distinct().groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("items")
    )
    # Null ids are ids too.
    named = names.select(F.col("doc_id").alias("n_id"), F.col("text_hash").alias("n_hash"), "items")
    match = F.col("doc_id").eqNullSafe(F.col("n_id")) & (F.col("text_hash") == F.col("n_hash"))
    found = stored(hits.join(named, match, "left_outer").select(*KEY, "n_hit", "items"))
    same = F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("text_hash") == F.col("f_hash"))
    found = found.withColumnRenamed("doc_id", "f_id").withColumnRenamed("text_hash", "f_hash")
    return counts.join(found, same, "left").select(
        *KEY,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The documents that hold no window of the benchmark."""
    found = contamination(docs.select("doc_id", "text"), benchmark, window, gram)
    hit = found.where("n_hit > 0").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    return docs.join(stored(hit.distinct()), same, "left_anti")
