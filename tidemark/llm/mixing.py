"""Mixing sources to target weights by weighted sampling without replacement.

Sources get shares of a budget by weight; none gives more than ``epochs`` times its size, and
what it cannot give goes to the others by weight. Of each source the mix first takes complete
epochs, then a fraction: its documents in the order of exponential keys, -ln(u) / quality, with
u fixed by the id's hash, until the rest of the budget is spent. So a document's
chance to come early grows with its quality, as if drawn one by one in proportion to it. The
last document is taken in part, so that a source gives its target to within a word.

The order within sources is one sort across tasks with running sizes carried from part to part
(``running``); a source that holds most rows is spread like any other. One row per source and
narrow rows without texts are all that is shuffled.

Null texts have no words; null sources are one source, the last. Documents without words are
taken with none. Rows that agree in id, size and quality may stand for each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, stored
from tidemark.llm.running import with_running_totals

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
SEED = 12
# Least quality: below it a document would hardly ever come.
FLOOR = 0.05
# ASCII characters that are neither letters nor spaces.
MARKS = r"[\x21-\x40\x5B-\x60\x7B-\x7E]"


def text_quality(text: Column) -> Column:
    """Share of the characters that are no ASCII digits or marks; ``FLOOR`` at least."""
    share = F.try_divide(F.length(F.regexp_replace(text, MARKS, "")), F.length(text))
    return F.greatest(F.coalesce(share, F.lit(0.0)), F.lit(FLOOR))


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")).cast("long")


def sampling_key(doc_id: Column, quality: Column, seed: int = SEED) -> Column:
    """An exponential number of rate ``quality``, fixed by the id."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", doc_id.cast("string"), F.lit(str(seed))).cast("binary")), 1, 13), 16, 10)
    u = (bits.cast("long").cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / quality


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, epochs: int) -> DataFrame:
    """``(source, source_size, start, number, target)`` for ``sizes (source, source_size)``.

    Filling all sources in proportion to weight, the one of least ``epochs * size / weight`` is
    full first. In that order, the level that the rest would reach is known from running totals,
    and the first source that it leaves below its limit tells the level of all that follow.
    """
    order = [F.col("source").isNull(), F.col("source").asc_nulls_last()]
    numbered = with_running_totals(sizes.withColumn("one", F.lit(1).cast("long")), order, ["one", "source_size"])
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    weighed = numbered.select(
        "source",
        "source_size",
        F.col("source_size_before").alias("start"),
        F.col("one_before").alias("number"),
        cycle[(F.col("one_before") % len(weights)).cast("int")].alias("weight"),
        (F.col("source_size") * epochs).alias("limit"),
    )
    ratio = F.col("limit") / F.col("weight")
    filled = stored(with_running_totals(weighed, [ratio, F.col("number")], ["limit", "weight"]))
    budget = filled.agg(F.sum("source_size") * share).scalar()
    weight = filled.agg(F.sum("weight")).scalar()
    level = F.try_divide(budget - F.col("limit_before"), weight - F.col("weight_before"))
    free = filled.withColumn("level", level).where(ratio > F.col("level"))
    least = free.agg(F.min_by("level", F.struct(ratio, "number"))).scalar()
    limit = F.col("limit").cast("double")
    return filled.select(
        "source",
        "source_size",
        "start",
        "number",
        F.coalesce(F.least(limit, least * F.col("weight")), limit).alias("target"),
    )


def mix(
    docs: DataFrame,
    quality: Column | None = None,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)`` for every row of ``docs (doc_id, text, source)``.

    ``taken`` counts the words that the mix takes, repeats included. ``weights`` go to the sources in
    code point order, over and over; ``share`` is the budget as a multiple of all words.
    """
    rate = text_quality(F.col("text")) if quality is None else quality
    rows = stored(
        docs.select(
            "doc_id",
            F.col("source").cast("string").alias("source"),
            word_count(F.col("text")).alias("size"),
            sampling_key(F.col("doc_id"), rate, seed).alias("key"),
            # Spreads rows that tie in all else over tasks.
            F.xxhash64("text").alias("tie"),
        )
    )
    sources = stored(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, epochs))
    named = rows.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    order = [F.col(c) for c in ("number", "key", "doc_id", "size", "tie")]
    ranked = with_running_totals(named, order, ["size"])
    whole = F.least(F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)), F.lit(epochs))
    rest = F.floor(F.col("target") - whole * F.col("source_size"))
    before = F.col("size_before") - F.col("start")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - before))
    return ranked.select("doc_id", "source", "size", "source_size", "target", (whole * F.col("size") + part).alias("taken"))
