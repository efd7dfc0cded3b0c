"""Periodic runs and the grammar behind them."""

import random

import brute
import numpy as np
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.periods import periodic_runs, word_runs
from tidemark.llm.queries import QUERIES
from tidemark.llm.recompression import Grammar


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=4))
def test_extensions_equal_comparing_word_by_word(texts):
    barriers = len(texts) + 1
    symbols = [0]
    for k, text in enumerate(texts):
        symbols += [barriers + x for x in text] + [k + 1]
    grammar = Grammar(np.array(symbols), barriers, max(map(len, texts)))
    n = len(symbols)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(1, n), np.arange(1, n)))
    i, j = i[i < j], j[i < j]

    def naive(a, b, step):
        count = 0
        while 0 <= a < n and 0 <= b < n and symbols[a] == symbols[b]:
            a, b, count = a + step, b + step, count + 1
        return count

    assert grammar.forward(i, j).tolist() == [naive(a, b, 1) for a, b in zip(i.tolist(), j.tolist())]
    assert grammar.backward(i, j).tolist() == [naive(a - 1, b - 1, -1) for a, b in zip(i.tolist(), j.tolist())]


def test_runs_equal_comparing_all_periods():
    rng = random.Random(11)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 6)):
            n, kinds = rng.choice([0, 1, 5, 12, 30, 120]), rng.choice([1, 2, 3, 6])
            words = [b"w%d" % rng.randrange(kinds) for _ in range(n)]
            if n > 20 and rng.random() < 0.5:
                p, a = rng.randint(1, n // 3), rng.randrange(n // 2)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            texts.append(words)
        assert [[tuple(r) for r in found.tolist()] for found in word_runs(texts)] == [brute.word_runs(w) for w in texts]


def test_one_text_of_one_word():
    assert word_runs([[b"a"] * 5000])[0].tolist() == [[0, 5000, 1]]
    assert len(word_runs([[b"a"] * 11])[0]) == 0


@pytest.mark.parametrize("kind", ["real", "edge", "empty"])
def test_query_equals_plain_version(request, spark, kind):
    sf_dir = SF if kind == "real" else request.getfixturevalue(f"{kind}_dir")
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in QUERIES["op11_recompression"](spark, sf_dir).collect()]
    assert sorted(got, key=str) == sorted(brute.runs_collapsed(docs), key=str)


def test_operator_returns_runs_and_texts(spark):
    docs = spark.createDataFrame([(1, "x " + "a b c " * 5 + "y", "r")], "doc_id long, text string, runs string")
    (row,) = periodic_runs(docs).collect()
    assert (row["n_words"], [tuple(r) for r in row["runs"]]) == (17, [(1, 15, 3)])
    assert row["collapsed"] == "x a b c y"
