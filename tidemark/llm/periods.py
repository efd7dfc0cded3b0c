"""Periodic runs of words in every text, by recompression.

A run is a stretch with a smallest period of q words, at least ``least`` words and two
periods long, that no neighbouring word extends. For each period p the places that are
multiples of p form a grid: a run of period p holds a grid place whose word equals the one
p further, so only such places are candidates, n log n of them at most. How far a candidate's
equality reaches to both sides is answered exactly by a grammar (``recompression``); no suffix
array is built. Equal stretches are one run with the least period found.

A batch of texts shares one grammar and is bounded in bytes; a single text is never cut, so
the longest text bounds a task's memory. Texts are independent: nothing is shuffled.

Null texts have no words. Rows with equal or null ids are texts of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bytes_of, texts_of
from tidemark.llm.recompression import Grammar

LEAST = 12
# Bytes of text that share a grammar, and candidates asked at once.
BATCH_BYTES = 1 << 20
ASKED = 1 << 18

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, int]:
    """All words as numbers, a barrier before the first text and behind each; where texts begin."""
    barriers = len(texts) + 1
    known: dict[bytes, int] = {}
    parts = [np.zeros(1, dtype=np.int64)]
    for k, words in enumerate(texts):
        ids = [known.setdefault(w, len(known)) for w in words]
        parts += [np.array(ids, dtype=np.int64) + barriers, np.array([k + 1])]
    starts = 1 + np.cumsum([0] + [len(words) + 1 for words in texts])[:-1]
    return np.concatenate(parts), starts, barriers


def _candidates(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid places and periods whose words agree, in portions; texts stand longest first."""
    text_of = np.repeat(np.arange(len(sizes)), sizes + 1)
    places, periods, held = [], [], 0
    # Where the texts that are long enough for a period end.
    last = len(sizes)
    for p in range(1, int(sizes[0]) // 2 + 1):
        while sizes[last - 1] < 2 * p:
            last -= 1
        end = int(starts[last - 1] + sizes[last - 1])
        hit = np.flatnonzero(symbols[p : end - p : p] == symbols[2 * p : end : p]) * p + p
        # Place 0 is the barrier before all texts, so the grid may begin at p.
        hit = hit[text_of[hit - 1] == text_of[hit - 1 + p]]
        if len(hit):
            places.append(hit)
            periods.append(np.full(len(hit), p))
            held += len(hit)
        if held >= ASKED:
            yield np.concatenate(places), np.concatenate(periods)
            places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def _least_period(runs: np.ndarray) -> np.ndarray:
    """Each stretch once, with its least period, in order of start, then period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), dtype=bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def word_runs(texts: list[list[bytes]], least: int = LEAST) -> list[np.ndarray]:
    """For each text an array of (start, length, period), in order of start, then period."""
    none = np.empty((0, 3), dtype=np.int64)
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    out = [none] * len(texts)
    if not order or len(texts[order[0]]) < max(2, least):
        return out
    sizes = np.array([len(texts[k]) for k in order])
    symbols, starts, barriers = _numbered([texts[k] for k in order])
    grammar = Grammar(symbols, barriers, int(sizes[0]))
    found = none
    for places, periods in _candidates(symbols, starts, sizes):
        ends = places + periods + grammar.forward(places, places + periods)
        begins = places - grammar.backward(places, places + periods)
        long = ends - begins >= np.maximum(least, 2 * periods)
        some = np.stack((begins[long], ends[long], periods[long]), axis=1)
        found = _least_period(np.concatenate((found, some)))
    owner = np.searchsorted(starts, found[:, 0], side="right") - 1
    cuts = np.searchsorted(owner, np.arange(len(sizes) + 1))
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        mine = found[a:b]
        out[order[k]] = np.stack((mine[:, 0] - starts[k], mine[:, 1] - mine[:, 0], mine[:, 2]), axis=1)
    return out


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words but for those that a run holds after its first period."""
    if not len(runs):
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edges)[:-1] == 0)])


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` for every row of ``docs (doc_id, text)``.

    ``collapsed`` holds the words that no run has after its first period, joined by a space.
    """

    def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                if texts and size + len(text) > BATCH_BYTES:
                    yield ids, texts
                    ids, texts, size = [], [], 0
                ids.append(doc)
                texts.append(text)
                size += len(text)
            if texts:
                yield ids, texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in portions(batches):
            # bytes.split() cuts at exactly the separators of SPACES.
            words = [text.split() for text in texts]
            runs = word_runs(words, least)
            flat = np.concatenate(runs)
            structs = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], ["start", "length", "period"])
            offsets = np.cumsum([0] + [len(r) for r in runs]).astype(np.int32)
            yield pa.record_batch(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), structs),
                    pa.array([_collapsed(w, r) for w, r in zip(words, runs)], pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return bytes_of(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(run, SCHEMA)
