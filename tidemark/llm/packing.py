"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of tokens. A window of ``WINDOW`` tokens, one training sequence, is
filled by visiting the queues in turn: each earns its weight's share of the window, serves the
whole tokens of its credit, and carries the rest, its deficit of less than one token, to the
next window. Weights are the shares of the corpus tokens unless others are given; with the
corpus' own all queues run dry in the last window together. With others, a queue that runs
dry leaves its share to the rest, in proportion to their weights, and a new phase begins. Since
a queue's credit after w windows of a phase is w times its quantum, what it has served by then
is known without serving the windows before: packing needs only the tokens before a text in its
queue, so windows, partitions and queues are filled independently and the deficit carries across
all of them. Windows are full, and sequences are cut from the run of windows without gaps:
only the last sequence can be short.

A source that would earn less than a token for a window shares one queue with its like,
and if they earn too little together they join the source of the largest weight. So there are at most
``WINDOW`` queues. A null source counts as the empty one. Null and empty texts hold the end
token only. Every row is packed, also if ids repeat or are null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from fractions import Fraction
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, stored, texts_of
from tidemark.llm.running import with_running_totals

SEQUENCE = 4096
WINDOW = SEQUENCE
# Weights are counted in whole parts of this.
PARTS = 10**12
END = 2
VOCABULARY = "word_bpe_49k.json"
# Most distinct words and chunks whose tokens a worker remembers; then it starts anew.
WORDS = 900_000

# How the vocabulary's own rules split a text, and what its words end with.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
MARKS = ".,;:!?"
SPECIAL = ("<|startoftext|>", "<|endoftext|>")

# Control characters, and what some take for space.
ODD = bytes([*range(9), 11, 12, *range(14, 32), *range(127, 161)])


class WordTokens:
    """Token ids of whole texts, each distinct word encoded once.

    Words are encoded apart only where the vocabulary treats them so for certain: in
    texts of Latin letters without control characters and special tokens. Any other text
    goes to the tokenizer as it is.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        if max(vocabulary.values()) > 65535:
            raise ValueError("token ids are kept in two bytes")
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith(WORD_END)]] = True
        self.words = regex.compile(WORD)
        # Of words, and of chunks: whatever stands between two spaces.
        self.known: dict[str, bytes] = {"": b""}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()

    def _plain(self, text: str) -> bool:
        try:
            latin = text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return len(latin.translate(None, ODD)) == len(latin) and not any(s in text for s in SPECIAL)

    def _learn(self, chunks: list[str]) -> None:
        # Most chunks are a word, or a word and a mark, and are not cut by the pattern.
        parts = {
            chunk: [chunk] if chunk.isalpha() else [chunk[:-1], chunk[-1]] if chunk[-1] in MARKS and chunk[:-1].isalpha() else self.words.findall(chunk)
            for chunk in chunks
        }
        new = list({w for words in parts.values() for w in words if w not in self.known})
        for i in range(0, len(new), 4096):
            some = new[i : i + 4096]
            ids = np.frombuffer(self.whole(" ".join(some)), dtype="<u2")
            cuts = (2 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(cuts) == len(some):
                raw = ids.tobytes()
                self.known.update((word, raw[a:b]) for word, a, b in zip(some, [0, *cuts], cuts))
            else:
                self.known.update((word, self.whole(word)) for word in some)
        for chunk, words in parts.items():
            if len(words) != 1 or words[0] != chunk:
                self.known[chunk] = b"".join([self.known[w] for w in words])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as two-byte numbers. Chunks are counted and put together as whole arrays."""
        plain = [self._plain(t) for t in texts]
        lower = pc.utf8_lower(pa.array([t for t, p in zip(texts, plain) if p], pa.large_string()))
        cut = pc.ascii_split_whitespace(lower)
        chunks = cut.flatten().dictionary_encode()
        names, at = chunks.dictionary.to_pylist(), chunks.indices.to_numpy(zero_copy_only=False)
        new = [c for c in names if c not in self.known]
        if len(self.known) + len(new) > WORDS:
            self.known = {"": b""}
            new = [c for c in names if c]
        self._learn(new)
        pieces = [self.known[c] for c in names]
        pool = np.frombuffer(b"".join(pieces), dtype="<u2")
        sizes = np.array([len(p) // 2 for p in pieces], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        counts = sizes[at]
        ends = np.concatenate(([0], np.cumsum(counts)))
        ids = pool[np.repeat(starts[at] - ends[:-1], counts) + np.arange(ends[-1])].tobytes()
        cuts = (2 * ends[cut.offsets.to_numpy(zero_copy_only=False)]).tolist()
        found = iter(ids[a:b] for a, b in zip(cuts, cuts[1:]))
        return [next(found) if p else self.whole(t) for t, p in zip(texts, plain)]


@cache
def word_tokens(path: str) -> WordTokens:
    """One for all tasks of a worker, which then know the words of those before."""
    return WordTokens(path)


def tokenized(docs: DataFrame, path: str | None = None, end: int = END) -> DataFrame:
    """``(doc_id, source, part, start, n, ids)``: ids as two-byte numbers; start within part and source.

    Each task finds the vocabulary on its own machine, unless a path is given.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(path or public_tokenizers.path(VOCABULARY))
        part_id = TaskContext.get().partitionId()
        closing = np.array([end], dtype="<u2").tobytes()
        filled: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch):
                ids = [x + closing for x in tokens.encode([t.decode("utf-8", "replace") for t in texts_of(part)])]
                starts = []
                for source, x in zip(part.column("source").to_pylist(), ids):
                    starts.append(filled.get(source, 0))
                    filled[source] = starts[-1] + len(x) // 2
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        part.column("source"),
                        pa.array(np.full(len(ids), part_id, dtype=np.int32)),
                        pa.array(starts, pa.int64()),
                        pa.array([len(x) // 2 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "source", "part", "start", "n", "ids"],
                )

    taken = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.col("text").cast("binary").alias("text"),
    )
    return taken.mapInArrow(run, "doc_id long, source string, part int, start long, n long, ids binary")


def phases(queues: list[tuple[str, int, int]]) -> dict[str, list[tuple[int, int, int, int, int]]]:
    """``(skip, own, before, first, total)`` for each phase of each queue of ``(queue, tokens, weight)``: tokens
    of the queue before the phase and in it, of the queues before it in the phase, of the phases before,
    and of the phase. A phase ends when a queue runs dry; queues without weight follow at last."""
    out: dict[str, list[tuple[int, int, int, int, int]]] = {q: [] for q, _, _ in queues}
    skipped = dict.fromkeys(out, 0)
    idle = [(q, tokens, tokens) for q, tokens, weight in queues if not weight]
    active, first = [q for q in queues if q[2]], 0
    while active or idle:
        if not active:
            active, idle = idle, []
        turns = min(Fraction(tokens, weight) for _, tokens, weight in active)
        taken = [turns.numerator * weight // turns.denominator for _, _, weight in active]
        total, before = sum(taken), 0
        for (q, _, _), own in zip(active, taken):
            if own:
                out[q].append((skipped[q], own, before, first, total))
            skipped[q] += own
            before += own
        first += total
        active = [(q, tokens - own, weight) for (q, tokens, weight), own in zip(active, taken) if tokens > own]
    return out


def _weights(sources: DataFrame, weights: Mapping[str, float] | None) -> DataFrame:
    """The sources with a whole weight: their tokens, or the given share. What the given ones leave of 1 goes
    to the other sources by their tokens; if there are none, the given ones are in proportion."""
    if weights is None:
        return sources.withColumn("weight", F.col("tokens").cast("decimal(38,0)"))
    if any(not w > 0 for w in weights.values()) or sum(weights.values()) > 1 + 1e-9:
        raise ValueError("weights must be above 0 and at most 1 together")
    spark = sources.sparkSession
    given = spark.createDataFrame([(s, float(w)) for s, w in weights.items()], "source string, given double")
    joined = sources.join(given, "source", "left")
    others = joined.agg(F.sum(F.when(F.col("given").isNull(), F.col("tokens")))).scalar()
    left = max(0.0, 1 - sum(weights.values()))
    share = F.coalesce("given", F.col("tokens") / others * left)
    # Sources without a share come last and are packed too.
    whole = F.round(share * PARTS).cast("decimal(38,0)")
    return joined.select("source", "tokens", whole.alias("weight"))


Plan = dict[str, list[tuple[int, int, int, int, int]]]


def queues(tokens: DataFrame, window: int = WINDOW, weights: Mapping[str, float] | None = None) -> tuple[DataFrame, Plan]:
    """``(source, part, base, queue)``, the tokens before a part in its queue, and the phases of each queue.

    One row per source and part. They are numbered across tasks, so neither a hot source nor a queue
    that many sources share is summed up in one.
    """
    parts = stored(tokens.groupBy("source", "part").agg(F.sum("n").alias("n")))
    sources = stored(_weights(parts.groupBy("source").agg(F.sum("n").alias("tokens")), weights))
    total = sources.agg(F.sum("weight")).scalar()
    # Ties for the largest go to the later name.
    largest = sources.agg(F.max(F.struct("weight", "source"))["source"]).scalar()
    ample = F.col("weight") * window >= total
    rest = sources.agg(F.sum(F.when(~ample, F.col("weight")).otherwise(0))).scalar()
    # By name: the shared queue, those of single sources, and that of sources without a share.
    shared = F.when(rest * window >= total, F.lit("")).otherwise(F.concat(F.lit("+"), largest))
    name = F.when(F.col("weight") == 0, F.lit("-")).when(ample, F.concat(F.lit("+"), "source")).otherwise(shared)
    named = stored(sources.select("source", "tokens", "weight", name.alias("queue")))
    # At most a window's tokens of queues reach the driver.
    sums = named.groupBy("queue").agg(F.sum("tokens").alias("tokens"), F.sum("weight").alias("weight"))
    held = sorted(sums.collect(), key=lambda r: r["queue"])
    dealt = phases([(r["queue"], int(r["tokens"]), int(r["weight"])) for r in held])
    owned = parts.join(named.select("source", "queue"), "source")
    summed = with_running_totals(owned, [F.col("queue"), F.col("source"), F.col("part")], ["n"])
    starts = stored(summed.groupBy("queue").agg(F.min("n_before").alias("first")))
    placed = summed.join(starts, "queue")
    return placed.select("source", "part", (F.col("n_before") - F.col("first")).alias("base"), "queue"), dealt


def pieces(
    x: int, n: int, own: int, before: int, first: int, total: int, window: int, sequence: int
) -> list[tuple[int, int, int]]:
    """``(start, length, position)`` of a text whose queue holds ``x`` tokens of a phase before its ``n``.

    ``served(w)`` is what the queue has served of the phase after w windows. Positions count all
    tokens; the phase begins at ``first``; pieces end with sequences.
    """

    def credit(tokens: int, w: int) -> int:
        return min(max(w * window - first, 0), total) * tokens // total

    def served(w: int) -> int:
        return credit(before + own, w) - credit(before, w)

    w = (first + x * total // own) // window
    while served(w) > x:
        w -= 1
    while served(w + 1) <= x:
        w += 1
    out, at = [], x
    while at < x + n:
        stop = min(x + n, served(w + 1))
        g = max(w * window, first) + credit(before, w + 1) - credit(before, w) + at - served(w)
        while at < stop:
            length = min(stop - at, sequence - g % sequence)
            out.append((at - x, length, g))
            at, g = at + length, g + length
        w += 1
    return out


def placed_pieces(
    x: int, n: int, plan: list[tuple[int, int, int, int, int]], window: int, sequence: int
) -> Iterator[tuple[int, int, int]]:
    """The pieces of a text whose queue holds ``x`` tokens before its ``n``, over the queue's phases."""
    for skip, own, before, first, total in plan:
        a, b = max(x, skip), min(x + n, skip + own)
        if a < b:
            for start, length, g in pieces(a - skip, b - a, own, before, first, total, window, sequence):
                yield a - x + start, length, g


def pack(
    docs: DataFrame,
    path: str | None = None,
    sequence: int = SEQUENCE,
    window: int = WINDOW,
    end: int = END,
    weights: Mapping[str, float] | None = None,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``; ids are four-byte
    little-endian numbers. ``docs`` has ``doc_id, source, text``. ``weights`` are target shares of sources;
    without them the corpus' own hold."""
    tokens = stored(tokenized(docs, path, end))
    bases, dealt = queues(tokens, window, weights)
    placed = tokens.join(stored(bases), ["source", "part"])
    placed = placed.select("doc_id", "ids", "n", (F.col("base") + F.col("start")).alias("x"), "queue")
    # Of queues there are at most as many as a window has tokens.
    plans = docs.sparkSession.sparkContext.broadcast(dealt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "ids"):
                rows: list[tuple] = []
                for doc, ids, n, x, queue in zip(*(c.to_pylist() for c in part.columns)):
                    wide = np.frombuffer(ids, dtype="<u2").astype("<u4")
                    for start, length, g in placed_pieces(x, n, plans.value[queue], window, sequence):
                        cut = wide[start : start + length].tobytes()
                        rows.append((doc, start, length, cut, zlib.crc32(cut), n, g // sequence, g % sequence))
                names = ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return placed.mapInArrow(
        run,
        "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
