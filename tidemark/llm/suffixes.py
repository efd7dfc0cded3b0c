"""Exact substring deduplication by refining buckets of suffixes.

Every byte string of 400 that starts in two places, anywhere in the corpus, is removed at
each place. Suffixes are put in buckets by their first q-gram of 50 bytes. A bucket is
refined by the bucket identifiers of its suffixes' later offsets: those of 50 bytes on tell apart what
differs within 100, and the identifiers so refined, taken 100 and then 200 bytes on, do the rest up to 400.
Identifiers are 64-bit names of (identifier, identifier of the later offset), so that every batch of
texts gives equal buckets equal names without asking; what it asks is which buckets others have too:

* Suffixes start at sampled places: of the places in a string where its 200 bytes could begin, the one
  of least identifier, so equal strings are sampled at the same place within them. A place
  stands for all the strings that chose it, a run of neighbouring starts.
* After two refinements (200 bytes): buckets of one suffix are finished, nothing else has them. Within a
  bucket, suffixes are sorted by the identifiers at the ends of all that their strings cover. What
  is still together is a repeat throughout.
* After the third (400 bytes): in buckets that fell apart, one suffix of each part and all that
  stand alone go on, each start by itself. Parts that are settled send one member for all.

Buckets are compared in packed arrays (``exchange``). Sampling keeps them to one suffix
in about a hundred: an identifier for every byte would be eight times the corpus.

Null texts count as empty. Rows with equal ids are texts of their own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.exchange import Made, Texts, asked, batches, buckets, finished
from tidemark.llm.rolling import mix, sliding_argmin, windows

STRING = 400
# Bytes of the first buckets, and of those that suffixes are sampled by.
FIRST = 50
GRAM = 200


def _named(one: np.ndarray, later: np.ndarray, step: int) -> np.ndarray:
    """A name for each pair of identifiers, ``step`` bytes apart; not linear in them, so that no order of parts is as good as another."""
    name = one * _FIRST + (later + np.uint64(step)) * _LATER
    name ^= name >> np.uint64(32)
    name *= _FIRST
    return name ^ (name >> np.uint64(29))


_FIRST, _LATER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Identifiers:
    """Bucket identifiers of all suffixes of a batch, refined up to a depth; deeper ones where asked for."""

    def __init__(self, sums: np.ndarray, first: int, depth: int) -> None:
        # Short strings begin with short q-grams.
        first = max(1, min(first, depth))
        self.depths, self.names = [first], [windows(sums, first)]
        while 2 * self.depths[-1] <= depth:
            step, last = self.depths[-1], self.names[-1]
            # The identifiers of the suffixes that start a depth later, which are as refined.
            later = last[step:]
            self.names.append(_named(last[: len(later)], later, step))
            self.depths.append(2 * step)

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        """Identifiers of the strings of one length, at least the first depth, from the given starts."""
        if length > 2 * self.depths[-1]:
            half = (length + 1) // 2
            return _named(self.at(starts, half), self.at(starts + (length - half), half), length - half)
        k = max(i for i, d in enumerate(self.depths) if d <= length)
        depth, names = self.depths[k], self.names[k]
        return names[starts] if depth == length else _named(names[starts], names[starts + (length - depth)], length - depth)

    def all(self, length: int) -> np.ndarray:
        if length in self.depths:
            return self.names[self.depths.index(length)]
        return self.at(np.arange(max(0, len(self.names[0]) + self.depths[0] - length)), length)


class Suffixes:
    """The sampled suffixes of a batch: q-gram and identifier, first and last start that chose them."""

    def __init__(self, texts: Texts, size: int, gram: int) -> None:
        self.sums = texts.sums()
        lengths = np.maximum(texts.ends - texts.starts - size + 1, 0)
        # All starts of strings that stay in their text.
        skip = np.repeat(texts.starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
        starts = np.arange(lengths.sum()) + skip
        self.identifiers = Identifiers(self.sums, FIRST, gram)
        hashes = self.identifiers.all(gram)
        chosen = sliding_argmin(hashes, size - gram + 1)[starts] if len(starts) else starts
        doc = np.repeat(np.arange(len(lengths)), lengths)
        new = np.flatnonzero((np.diff(chosen, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
        self.first = starts[new]
        self.last = starts[np.concatenate((new[1:], [len(starts)])) - 1] if len(new) else new
        self.gram = hashes[chosen[new]]
        # The strings from the first and the last start overlap, so together they cover all.
        ends = mix(self.identifiers.at(self.first, size) ^ mix(self.identifiers.at(self.last, size) + np.uint64(1)))
        places = (self.last - self.first).astype(np.uint64) << np.uint64(32) | (chosen[new] - self.first).astype(np.uint64)
        self.name = mix(ends ^ mix(places + np.uint64(1)))
        order = np.lexsort((self.name, self.gram))
        g, n = self.gram[order], self.name[order]
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (g[1:] != g[:-1]) | (n[1:] != n[:-1])
        self.entries = order[fresh]
        self.entry_of = np.empty(len(order), dtype=np.int64)
        self.entry_of[order] = np.cumsum(fresh) - 1
        self.counts = np.bincount(self.entry_of, minlength=len(self.entries))


_PART = np.dtype([("name", "<u8"), ("twice", "u1")])


def _refined(grams: np.ndarray, more: np.ndarray, batch: np.ndarray) -> np.ndarray:
    """1: the suffix's strings repeat throughout; 2: it goes on to the second refinement."""
    order = np.lexsort((batch, more["name"], grams))
    g, n = grams[order], more["name"][order]
    bucket_new = np.concatenate(([True], g[1:] != g[:-1]))
    part_new = bucket_new | np.concatenate(([True], n[1:] != n[:-1]))
    bucket, part = np.cumsum(bucket_new) - 1, np.cumsum(part_new) - 1
    members = np.bincount(part, weights=1 + (more["twice"][order] > 0))
    parts = np.bincount(bucket[part_new])
    repeated = members[part] > 1
    apart = parts[bucket] > 1
    flags = np.empty(len(order), dtype=np.uint8)
    flags[order] = repeated | ((apart & (~repeated | part_new)).astype(np.uint8) << 1)
    return flags


def _twice(hashes: np.ndarray, more: np.ndarray, batch: np.ndarray) -> np.ndarray:
    _, inverse = np.unique(hashes, return_inverse=True)
    return (np.bincount(inverse, weights=1 + (more > 0)) > 1)[inverse]


def _spread(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All starts of the given runs."""
    lengths = last - first + 1
    skip = np.repeat(first - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(lengths.sum()) + skip


def digests(docs: DataFrame, size: int = STRING, gram: int = GRAM) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for every row of ``docs (doc_id, text)``."""
    return _deduplicated(docs, size, gram, True)


def deduplicated(docs: DataFrame, size: int = STRING, gram: int = GRAM) -> DataFrame:
    """As ``digests``, with the remaining bytes themselves as ``kept``."""
    return _deduplicated(docs, size, gram, False)


def _deduplicated(docs: DataFrame, size: int, gram: int, digest: bool) -> DataFrame:
    def first(texts: Texts) -> Made:
        s = Suffixes(texts, size, gram)
        more = np.zeros(len(s.entries), dtype=_PART)
        more["name"], more["twice"] = s.name[s.entries], s.counts > 1
        return s.gram[s.entries], more

    def single(s: Suffixes, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        on = np.flatnonzero(flags[s.entry_of] & 2) if len(flags) else np.empty(0, np.int64)
        starts = _spread(s.first[on], s.last[on])
        return starts, s.identifiers.at(starts, size)

    def second(texts: Texts, flags: np.ndarray) -> Made:
        _, hashes = single(Suffixes(texts, size, gram), flags)
        unique, counts = np.unique(hashes, return_counts=True)
        return unique, counts > 1

    def result(texts: Texts, flags: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
        s = Suffixes(texts, size, gram)
        whole = np.flatnonzero(flags[s.entry_of] & 1) if len(flags) else np.empty(0, np.int64)
        starts, hashes = single(s, flags)
        if len(starts):
            starts = starts[twice[np.searchsorted(np.unique(hashes), hashes)] > 0]
        edges = np.zeros(len(texts.raw) + 1, dtype=np.int64)
        np.add.at(edges, s.first[whole], 1)
        np.add.at(edges, s.last[whole] + size, -1)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + size, -1)
        gone = np.cumsum(edges)[:-1] > 0
        raw = np.frombuffer(texts.raw, dtype=np.uint8)
        rows: list[list] = [[], [], [], []]
        for a, b in zip(texts.starts.tolist(), texts.ends.tolist()):
            cut = gone[a:b]
            kept = raw[a:b][~cut].tobytes()
            rows[0].append(b - a)
            rows[1].append(b - a - len(kept))
            rows[2].append(int(np.count_nonzero(np.diff(cut.astype(np.int8), prepend=0) == 1)))
            rows[3].append(hashlib.sha256(kept).hexdigest() if digest else kept)
        kinds = [pa.int64()] * 3 + [pa.string() if digest else pa.binary()]
        return pa.record_batch(
            [pa.array(texts.ids, pa.int64()), *[pa.array(r, k) for r, k in zip(rows, kinds)]],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256" if digest else "kept"],
        )

    held = batches(docs)
    count = buckets(held)
    held = asked(held, count, first, _refined, "told1", _PART)
    held = asked(held, count, second, _twice, "told2", "u1")
    kept = "kept_sha256 string" if digest else "kept binary"
    return finished(held, result, f"doc_id long, n_bytes long, n_removed long, n_spans long, {kept}")
