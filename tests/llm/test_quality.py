"""Votes of nearest neighbours against plain loops; conflicting labels; queues over tasks."""

import math

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from tidemark.llm import lsa, packing
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES


def plain_score(model, text):
    found, counts = lsa.terms(text)
    if not len(found):
        return model.prior
    weights = {int(t): math.sqrt(c) for t, c in zip(found, counts)}
    norm = math.sqrt(sum(w * w for w in weights.values()))
    place = [sum(w / norm * float(model.weights[t]) * float(model.space[t, d]) for t, w in weights.items()) for d in range(model.space.shape[1])]
    length = math.sqrt(sum(x * x for x in place)) or 1.0
    near = sorted(((sum(x / length * float(v) for x, v in zip(place, row)), k) for k, row in enumerate(model.vectors)), reverse=True)
    votes = [(min(max(c, 1e-3), 1) ** 16, model.labels[k]) for c, k in near[: model.neighbours]]
    return sum(v * y for v, y in votes) / sum(v for v, _ in votes)


def test_scores_equal_plain_votes(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = lsa.train(docs, labels, ~lsa.held_out())
    got = {r["doc_id"]: r["score"] for r in QUERIES["op2_quality"](spark, SF).collect()}
    some = docs.select("doc_id", "text").where("doc_id % 9 = 0").collect()
    assert len(some) > 15
    for r in some:
        assert got[r["doc_id"]] == pytest.approx(plain_score(model, (r["text"] or "").encode()), abs=2e-3)


def test_conflicting_labels_follow_the_majority(spark):
    docs = spark.createDataFrame([(i, f"text {'word ' * i}") for i in range(1, 5)], "doc_id long, text string")
    rows = [(1, 1), (1, 0), (2, 1), (2, 1), (2, 0), (3, 0), (4, 1), (4, None), (None, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    for _ in range(2):
        model = lsa.train(docs, labels.repartition(3), F.lit(True))
        assert sorted(model.labels.tolist()) == [0, 0, 1, 1] and model.prior == 0.6


def test_the_driver_gets_terms_and_no_texts(spark):
    docs = spark.createDataFrame([(i, "long text " * 200_000) for i in range(4)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id long, quality int")
    model = lsa.train(docs, labels, F.lit(True))
    assert model.vectors.shape[0] == 4 and model.vectors.nbytes < 10_000


def test_bases_count_the_tokens_before_in_each_queue(spark):
    """Thousands of small sources share a queue, which no task sums up alone."""
    rows = [(i, "big" if i % 3 == 0 else f"s{i % 2000}", "word " * (i % 5)) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(6)
    tokens = packing.tokenized(docs).cache()
    bases, plan = packing.queues(tokens, 512)
    assert set(plan) == {"+big", ""}
    held = {(r["source"], r["part"]): r["n"] for r in tokens.groupBy("source", "part").agg(F.sum("n").alias("n")).collect()}
    found = bases.collect()
    assert len(found) == len(held)
    filled = {}
    for r in sorted(found, key=lambda r: (r["queue"], r["source"], r["part"])):
        assert r["base"] == filled.get(r["queue"], 0)
        filled[r["queue"]] = r["base"] + held[r["source"], r["part"]]
    text = bases._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(queue" not in text
