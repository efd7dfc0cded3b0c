"""The packed exchange over many batches and buckets, and identifiers of byte strings."""

import random

import brute
import numpy as np
import pytest
from test_groups import frame, many

from tidemark.llm import blocks, exchange, suffixes
from tidemark.llm.suffixes import Identifiers


@pytest.mark.parametrize("fanout", [2, 5])
def test_results_hold_over_several_levels(spark, monkeypatch, fanout):
    monkeypatch.setattr(exchange, "BATCH_BYTES", 6000)
    monkeypatch.setattr(exchange, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(exchange, "FANOUT", fanout)
    rows = many(spark, 20)
    assert len(exchange._levels(exchange.buckets(exchange.batches(frame(spark, rows))))) > 1
    got = [tuple(r) for r in blocks.digests(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(brute.repeats_removed(rows))
    got = [tuple(r) for r in suffixes.digests(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(brute.bytes_removed(rows))


def test_arrays_grow_as_the_texts_do(spark, monkeypatch):
    """Texts four times as many send about four times the arrays, not sixteen times."""
    monkeypatch.setattr(exchange, "BATCH_BYTES", 2000)
    monkeypatch.setattr(exchange, "BUCKET_BYTES", 1000)
    monkeypatch.setattr(exchange, "FANOUT", 8)
    sent = []
    plain = exchange._judged

    def counting(rows, *more):
        sent.append(rows.count())
        return plain(rows, *more)

    monkeypatch.setattr(exchange, "_judged", counting)
    rng = random.Random(2)

    def arrays(n):
        sent.clear()
        texts = [(i, " ".join(f"w{rng.randrange(50_000)}" for _ in range(150))) for i in range(n)]
        blocks.digests(frame(spark, texts, 1)).collect()
        # Levels differ by one at most; each sends at most FANOUT arrays a batch.
        return max(sent), len(sent)

    small, _ = arrays(50)
    large, levels = arrays(200)
    assert levels > 2 and large < 6 * small


def test_levels_lead_to_every_bucket():
    assert exchange._levels(exchange.FANOUT) == [1]
    assert exchange._levels(exchange.FANOUT + 1) == [exchange.FANOUT, 1]
    assert exchange._levels(exchange.FANOUT**2 + 1) == [exchange.FANOUT**2, exchange.FANOUT, 1]


@pytest.mark.parametrize("first, length", [(50, 400), (7, 30), (1, 1), (3, 13), (200, 401)])
def test_identifiers_are_equal_for_equal_strings_only(first, length):
    rng = random.Random(first)
    piece = bytes(rng.choices(b"abc", k=500))
    text = piece + b"-" + piece[3:450] + bytes(rng.choices(b"ab", k=600)) + b"a" * 900
    sums = exchange.Texts.of([1], [text]).sums()
    names = Identifiers(sums, first, length).all(length)
    strings = [text[i : i + length] for i in range(len(text) - length + 1)]
    assert len(names) >= len(strings)
    _, by_name = np.unique(names[: len(strings)], return_inverse=True)
    known = {}
    assert [known.setdefault(s, len(known)) for s in strings]
    pairs = {(known[s], int(n)) for s, n in zip(strings, by_name)}
    assert len(pairs) == len(known) == len(set(by_name.tolist()))


def test_swapped_parts_have_other_identifiers():
    """Parts of one q-gram's length in every order: as many names as orders."""
    parts = [b"aaab", b"abba", b"bbab", b"baaa", b"abab", b"bbbb", b"aabb", b"babb"]
    rng = random.Random(1)
    texts = list({b"".join(rng.sample(parts, 8)) for _ in range(500)})
    made = exchange.Texts.of(list(range(len(texts))), texts)
    names = Identifiers(made.sums(), 4, 32).at(made.starts, 32)
    assert len(set(names.tolist())) == len(texts)


def test_deeper_identifiers_are_made_where_asked_for():
    rng = random.Random(6)
    text = bytes(rng.choices(b"ab", k=300)) * 3
    sums = exchange.Texts.of([1], [text]).sums()
    shallow = Identifiers(sums, 5, 20)
    starts = np.arange(len(text) - 130 + 1)
    for length in (20, 33, 41, 80, 130):
        strings = [text[i : i + length] for i in starts]
        names = shallow.at(starts, length).tolist()
        assert len(set(zip(strings, names))) == len(set(strings)) == len(set(names))
