"""Substring deduplication by fixed-block anchors.

Each text is a reference: its non-overlapping blocks of seven words, from its start, are the
index. Each text is also a probe: every rolling window of seven words is looked up in
the index. A repeat of 13 words or more holds a whole block of the reference, wherever it
begins, so every such repeat is anchored. Around anchors, each window of 13 words is
compared across texts; windows that hit overlap to maximal exact repeats. A window
goes if a document with a smaller id holds it too. Windows are judged on the input.

Index, probes and windows are exchanged as packed hashes (``exchange``), with one entry per
batch for however many copies: no pair of documents is ever formed. Anchors may be found
too many, never too few; windows are compared by 64-bit hashes.

Null and empty texts have no words. A row whose id is null loses nothing and takes nothing from
others. Rows with equal ids don't take from each other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.exchange import Made, Texts, asked, batches, buckets, finished
from tidemark.llm.rolling import prefix, ranges, windows, word_bounds

WINDOW = 13
# A window of 13 words at any place holds a whole one of the blocks of seven.
BLOCK = (WINDOW + 1) // 2
LAST = np.iinfo(np.int64).max


class Words:
    """The words of a batch of texts: bounds, documents, and hashes of runs of them."""

    def __init__(self, texts: Texts) -> None:
        self.starts, self.ends = word_bounds(texts.raw)
        self.doc = np.searchsorted(texts.ends, self.starts)
        self.first = np.searchsorted(self.starts, texts.starts)
        self.after = np.searchsorted(self.starts, texts.ends)
        self.sums = prefix(ranges(texts.sums(), self.starts, self.ends))

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all runs that stay in one text."""
        found = windows(self.sums, size)
        inside = np.flatnonzero(self.doc[: len(found)] == self.doc[size - 1 : size - 1 + len(found)])
        return inside, found[inside]


def _anchors(texts: Texts, size: int) -> Made:
    words = Words(texts)
    at, hashes = words.runs(size)
    aligned = (at - words.first[words.doc[at]]) % size == 0
    unique, inverse = np.unique(hashes, return_inverse=True)
    is_block = np.zeros(len(unique), dtype=bool)
    is_block[inverse[aligned]] = True
    least, most = np.full(len(unique), LAST), np.full(len(unique), -1)
    np.minimum.at(least, inverse, words.doc[at])
    np.maximum.at(most, inverse, words.doc[at])
    return unique, is_block.astype(np.uint8) | ((least != most).astype(np.uint8) << 1)


def _by_hash(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each entry's hash, and how many entries each has."""
    _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    return inverse, counts


def _meets(hashes: np.ndarray, more: np.ndarray, batch: np.ndarray) -> np.ndarray:
    """Whether a block of one text has the words, and another text has them too."""
    group, counts = _by_hash(hashes)
    block = np.bincount(group, weights=more & 1) > 0
    twice = (counts > 1) | (np.bincount(group, weights=more >> 1) > 0)
    return (block & twice)[group]


def _candidates(texts: Texts, met: np.ndarray, window: int, size: int) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, and first words and hashes of the windows that hold an anchor."""
    words = Words(texts)
    at, hashes = words.runs(size)
    anchored = np.zeros(len(words.starts) + 1, dtype=np.int64)
    anchored[at + 1] = met[np.searchsorted(np.unique(hashes), hashes)] > 0 if len(at) else 0
    anchored = np.cumsum(anchored)
    first, found = words.runs(window)
    some = anchored[first + (window - size + 1)] > anchored[first]
    return words, first[some], found[some]


def _ids(texts: Texts) -> np.ndarray:
    return np.array([LAST if i is None else i for i in texts.ids], dtype=np.int64)


def _least(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    unique, inverse = np.unique(hashes, return_inverse=True)
    least = np.full(len(unique), LAST)
    np.minimum.at(least, inverse, ids)
    return unique, inverse, least


def _earlier(hashes: np.ndarray, least: np.ndarray, batch: np.ndarray) -> np.ndarray:
    """Whether another batch has the window in a document with a smaller id."""
    group, counts = _by_hash(hashes)
    lowest = np.full(len(counts), LAST)
    np.minimum.at(lowest, group, least)
    return lowest[group] < least


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text)`` for every row of ``docs (doc_id, text)``.

    ``kept_text`` is null where nothing is removed.
    """
    return _deduplicated(docs, window, False)


def digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)``: of the kept words joined by spaces."""
    return _deduplicated(docs, window, True)


def _deduplicated(docs: DataFrame, window: int, digest: bool) -> DataFrame:
    size = (window + 1) // 2

    def second(texts: Texts, met: np.ndarray) -> Made:
        words, first, found = _candidates(texts, met, window, size)
        unique, _, least = _least(found, _ids(texts)[words.doc[first]])
        return unique, least

    def result(texts: Texts, met: np.ndarray, earlier: np.ndarray) -> pa.RecordBatch:
        words, first, found = _candidates(texts, met, window, size)
        ids = _ids(texts)
        own = ids[words.doc[first]]
        _, inverse, least = _least(found, own)
        hit = first[((earlier[inverse] > 0) | (least[inverse] < own)) & (own != LAST)] if len(first) else first
        edges = np.zeros(len(words.starts) + 1, dtype=np.int64)
        np.add.at(edges, hit, 1)
        np.add.at(edges, hit + window, -1)
        gone = np.cumsum(edges)[:-1] > 0
        total = np.concatenate(([0], np.cumsum(gone)))
        n, removed, kept = [], [], []
        for a, b in zip(words.first.tolist(), words.after.tolist()):
            n.append(b - a)
            removed.append(int(total[b] - total[a]))
            text = None
            if digest or removed[-1]:
                left = np.flatnonzero(~gone[a:b]) + a
                text = b" ".join([texts.raw[s:e] for s, e in zip(words.starts[left].tolist(), words.ends[left].tolist())])
            kept.append(hashlib.sha256(text).hexdigest() if digest else text)
        return pa.record_batch(
            [
                pa.array(texts.ids, pa.int64()),
                pa.array(n, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(kept, pa.string() if digest else pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept_sha256" if digest else "kept_text"],
        )

    held = batches(docs)
    count = buckets(held)
    held = asked(held, count, lambda t: _anchors(t, size), _meets, "told1", "u1", short=True)
    held = asked(held, count, second, _earlier, "told2", "<i8")
    name = "kept_sha256" if digest else "kept_text"
    return finished(held, result, f"doc_id long, n_words long, n_removed long, {name} string")
