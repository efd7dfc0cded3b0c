"""Each sequence has the mixture, the corpus' own or a given one."""

from collections import defaultdict

import pytest

from tidemark.llm import packing


def corpus(spark):
    rows = [(i, f"s{i % 5}", " ".join(["word"] * (40 + i * 37 % 300))) for i in range(600)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(6)


def held(docs, **options):
    got = packing.pack(docs, **options).collect()
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    shares, total, spans = defaultdict(lambda: defaultdict(int)), defaultdict(int), []
    for r in got:
        shares[r["sequence_id"]][source[r["doc_id"]]] += r["length"]
        total[source[r["doc_id"]]] += r["length"]
        spans.append((r["sequence_id"], r["offset"], r["length"], r["doc_id"], r["start"], r["doc_tokens"]))
    return shares, total, sorted(spans)


def check_whole(spans, sequence):
    at = 0
    for s, offset, length, *_ in spans:
        assert s * sequence + offset == at
        at += length
    texts = defaultdict(list)
    for _, _, length, doc, start, n in spans:
        texts[doc].append((start, length, n))
    for parts in texts.values():
        at = 0
        for start, length, n in sorted(parts):
            assert start == at
            at += length
        assert at == n


def test_each_default_sequence_has_the_corpus_mixture(spark):
    shares, total, spans = held(corpus(spark))
    everything = sum(total.values())
    check_whole(spans, packing.SEQUENCE)
    full = [s for s in shares if (s + 1) * packing.SEQUENCE <= everything]
    assert len(full) > 10
    for s in full:
        for name, n in total.items():
            assert abs(shares[s][name] - packing.SEQUENCE * n / everything) < 2.01


@pytest.mark.parametrize("weights", [{"s0": 0.5, "s1": 0.25}, {"s0": 0.1, "s1": 0.2, "s2": 0.3, "s3": 0.1, "s4": 0.3}, {"s3": 1.0}])
def test_given_weights_hold_until_a_source_runs_dry(spark, weights):
    sequence = 256
    shares, total, spans = held(corpus(spark), sequence=sequence, window=sequence, weights=weights)
    check_whole(spans, sequence)
    others = sum(n for s, n in total.items() if s not in weights)
    want = {s: weights.get(s, (1 - sum(weights.values())) * n / others if others else 0) for s, n in total.items()}
    until = min(total[s] / w for s, w in want.items() if w)
    full = [s for s in shares if (s + 1) * sequence <= until]
    assert len(full) > 5
    for s in full:
        for name, w in want.items():
            assert abs(shares[s][name] - sequence * w) < 2.01


def test_weights_must_be_shares(spark):
    with pytest.raises(ValueError):
        packing.pack(corpus(spark), weights={"s0": 0.8, "s1": 0.4})


def test_phases_take_every_token():
    plan = packing.phases([("a", 100, 1), ("b", 7, 3), ("c", 50, 2)])
    assert {q: sum(p[1] for p in ps) for q, ps in plan.items()} == {"a": 100, "b": 7, "c": 50}
    assert all(len(ps) == 1 for ps in packing.phases([("a", 9, 9), ("b", 4, 4)]).values())
