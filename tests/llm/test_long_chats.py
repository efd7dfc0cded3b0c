"""Conversations of many turns cost no more than their length."""

import time

from pyspark.sql import functions as F

from tidemark.llm import chat


def formatted(spark, n):
    role = F.when(F.col("id") % 5 == 0, "user").otherwise("assistant")
    rows = spark.range(n).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"),
        F.concat(F.lit("é <| \\ "), F.col("id").cast("string")).alias("text"),
    )
    made = chat.format_conversations(rows)
    return made.select(
        chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_mask")).alias("loss")
    ).first()


def test_blocks_of_spans_read_back(spark):
    for n in (1, 2, 3, 7, 50, 1000):
        row = formatted(spark, n)
        texts = [f"é <| \\ {i}" for i in range(n)]
        assert [t["text"] for t in row["turns"]] == texts
        assert row["loss"] == "".join(t for i, t in enumerate(texts) if i % 5)


def test_time_grows_with_the_turns(spark):
    formatted(spark, 100)
    took = []
    for n in (8_000, 32_000):
        start = time.perf_counter()
        assert len(formatted(spark, n)["turns"]) == n
        took.append(time.perf_counter() - start)
    # Four times the turns; sixteen times the time if it were quadratic.
    assert took[1] < 10 * took[0]
