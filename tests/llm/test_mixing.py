"""Mixing sources: against a plain version, and the properties of the sample."""

from collections import Counter

import brute
import pytest
from conftest import SF
from pyspark.sql import functions as F

from tidemark.llm.mixing import mix
from tidemark.llm.queries import QUERIES
from tidemark.llm.running import with_running_totals


@pytest.mark.parametrize("kind", ["real", "edge", "empty"])
def test_query_equals_plain_version(request, spark, kind):
    sf_dir = SF if kind == "real" else request.getfixturevalue(f"{kind}_dir")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    want = sorted(brute.mixture([tuple(r) for r in docs.collect()]), key=str)
    got = sorted((tuple(r) for r in QUERIES["op12_mixing"](spark, sf_dir).collect()), key=str)
    assert [(*g[:3], g[4]) for g in got] == [(*w[:3], w[4]) for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])


@pytest.fixture(scope="module")
def uneven(spark):
    """One source holds a third of the rows, one no words, one no name; many are tiny."""
    rows = [(i, "hot" if i % 3 == 0 else None if i % 97 == 0 else f"s{i % 41:02}", "w " * (i % 17)) for i in range(6000)]
    rows += [(10_000 + i, "void", "") for i in range(50)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(7)


def test_sources_meet_their_targets(uneven):
    rows = mix(uneven).collect()
    taken, target, size = Counter(), {}, Counter()
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        size[r["source"]] += r["size"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    for s in size:
        assert target[s] <= 2 * size[s] and 0 <= target[s] - taken[s] < 1 + 1e-6


def test_reruns_agree_whatever_the_partitions(uneven):
    one = sorted(map(tuple, mix(uneven).collect()), key=str)
    assert one == sorted(map(tuple, mix(uneven.repartition(3)).collect()), key=str)


def test_better_documents_come_more_often(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("w").alias("text"), F.lit("s").alias("source"))
    good = F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)
    # A fifth of the words: by the law of drawing in proportion, the good come about four times as often at first.
    taken = mix(rows, quality=good, weights=(1,), share=0.2, epochs=1).where("taken > 0")
    even, odd = (taken.where(F.col("doc_id") % 2 == k).count() for k in (0, 1))
    assert even + odd == 4000 and 3.2 < even / odd < 3.9


def test_running_totals_cross_partitions(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") * 7919 % 5000 % 13).alias("v"))
    got = {r["k"]: r["v_before"] for r in with_running_totals(rows.repartition(9), [F.col("k")], ["v"]).collect()}
    total = 0
    for k in range(5000):
        assert got[k] == total
        total += k % 13
