"""Counting hashed strings across a corpus without a row for each.

Texts are kept in batches of a few megabytes, written once. To learn which of its strings
occur elsewhere, a batch sends their hashes, sorted and without repeats, as one packed
array per bucket of hash values; a bucket judges the arrays of all batches together and
answers each with one byte per entry, in the order they came. A string that half the
texts hold costs one entry a batch, and buckets are as many as the corpus needs for each
to stay of one size.

A batch never sends to more than ``FANOUT`` places, or arrays would become ever more and ever
smaller as batches and buckets both grow. Where there are more buckets, it sends to ranges of
them; about as many batches' arrays for a range are merged to one of a batch's size, which sends
on within the range, level after level. Answers go back the same way: what was merged is kept,
and merged again to tell whose each answer is. So arrays grow in number as the texts do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, texts_of
from tidemark.llm.rolling import byte_prefix

BATCH_BYTES = 3 << 20
# Text behind one bucket; with a hash every byte it would receive about so many entries.
BUCKET_BYTES = 6 << 20
FANOUT = 256


@dataclass
class Texts:
    """The texts of a batch one after another, a line feed behind each."""

    ids: list
    raw: bytes
    starts: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, ids: list, texts: list[bytes]) -> Texts:
        ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) - 1
        starts = ends - np.array([len(t) for t in texts], dtype=np.int64)
        return cls(ids, b"\n".join([*texts, b""]), starts, ends)

    def sums(self) -> np.ndarray:
        return byte_prefix(self.raw)


Made = tuple[np.ndarray, np.ndarray]


def batches(docs: DataFrame) -> DataFrame:
    """``(batch, ids, sizes, blob)``: texts of ``docs (doc_id, text)`` in compressed batches."""

    def rows(incoming: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
        ids, texts, size = [], [], 0
        for batch in incoming:
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                if texts and size + len(text) > BATCH_BYTES:
                    yield ids, texts
                    ids, texts, size = [], [], 0
                ids.append(doc)
                texts.append(text)
                size += len(text)
        if texts:
            yield ids, texts

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        packer = zstandard.ZstdCompressor(level=3)
        for number, (ids, texts) in enumerate(rows(incoming)):
            yield pa.record_batch(
                [
                    pa.array([task + number], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                    pa.array([packer.compress(b"".join(texts))], pa.binary()),
                ],
                ["batch", "ids", "sizes", "blob"],
            )

    taken = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return stored(taken.mapInArrow(run, "batch long, ids array<long>, sizes array<long>, blob binary"))


def _each(rows: pa.RecordBatch) -> Iterator[dict]:
    """One row after another as Python values, so that one batch of texts is open at a time."""
    for i in range(rows.num_rows):
        yield rows.slice(i, 1).to_pylist()[0]


def _open(row: dict) -> Texts:
    raw = zstandard.ZstdDecompressor().decompress(row["blob"], max_output_size=max(1, sum(row["sizes"])))
    cuts = np.concatenate(([0], np.cumsum(row["sizes"], dtype=np.int64))).tolist()
    return Texts.of(row["ids"], [raw[a:b] for a, b in zip(cuts, cuts[1:])])


def _told(row: dict) -> list[np.ndarray]:
    """The answers so far, each as one array in the order of what was sent."""
    out = []
    for name in sorted(k for k in row if k.startswith("told")):
        parts = sorted(row[name] or [], key=lambda x: x["bucket"])
        out.append(np.frombuffer(b"".join(bytes(p["flags"]) for p in parts), dtype=np.uint8))
    return out


def buckets(held: DataFrame) -> int:
    """As many buckets as the corpus needs for each to be of one size."""
    total = held.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    return max(8, -(-total // BUCKET_BYTES))


def asked(
    held: DataFrame,
    count: int,
    make: Callable[..., Made],
    judge: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray],
    name: str,
    extra: str,
    short: bool = False,
) -> DataFrame:
    """``held`` with a column ``name``: the answers to what ``make(texts, *told)`` sends.

    ``make`` returns sorted hashes and what goes with each, as an array of type ``extra``;
    ``judge(hashes, extras, batches)`` returns a byte for each entry of a bucket. ``short``
    sends the lower half of the hashes only, for answers that may err on the side of yes.
    """
    levels = _levels(count)

    def send(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in incoming:
            for row in _each(rows):
                hashes, more = make(_open(row), *_told(row))
                if len(hashes):
                    more = np.ascontiguousarray(more.astype(extra))
                    yield pa.RecordBatch.from_pandas(_cut(row["batch"], hashes, more, count, levels[0], short and len(levels) == 1), preserve_index=False)

    sent = held.mapInArrow(send, SENT)
    batches = held.count() if len(levels) > 1 else 0
    told = _judged(sent, batches, count, levels, judge, extra, short)
    # At most as many parts as a batch sends to, each a byte for every entry of the batch.
    told = stored(
        told.withColumnRenamed("unit", "batch").groupBy("batch").agg(F.collect_list(F.struct(F.col("slot").alias("bucket"), "flags")).alias(name))
    )
    return held.join(told, "batch", "left")


SENT = "unit long, slot long, hashes binary, more binary"
ANSWERED = "unit long, slot long, flags binary"


def _levels(count: int) -> list[int]:
    """Buckets behind one slot at each level, the last 1; a slot leads on to ``FANOUT`` at most."""
    levels = [1]
    while count > levels[0] * FANOUT:
        levels.insert(0, levels[0] * FANOUT)
    return levels


def _cut(unit: int, hashes: np.ndarray, more: np.ndarray, count: int, behind: int, short: bool) -> pd.DataFrame:
    """Sorted hashes and what goes with them, an array for each slot of ``behind`` buckets that they fall in."""
    at = (((hashes >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)) // np.uint64(behind)
    starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    ends = [*starts[1:].tolist(), len(at)]
    sent = hashes.astype("<u4" if short else "<u8")
    width = more.dtype.itemsize
    # Bytes of equal place together: the high ones of ids are mostly alike.
    planes = [more[a:b].view(np.uint8).reshape(-1, width).T.tobytes() for a, b in zip(starts.tolist(), ends)]
    return pd.DataFrame(
        {
            "unit": np.full(len(starts), unit, dtype=np.int64),
            "slot": at[starts].astype(np.int64),
            "hashes": [sent[a:b].tobytes() for a, b in zip(starts.tolist(), ends)],
            "more": planes,
        }
    )


def _opened(rows: pd.DataFrame, extra: str, short: bool) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Hashes, what goes with them, and the number of entries of each row."""
    hashes = [np.frombuffer(h, dtype="<u4" if short else "<u8") for h in rows["hashes"]]
    width = np.dtype(extra).itemsize
    more = [np.ascontiguousarray(np.frombuffer(m, np.uint8).reshape(width, -1).T).view(extra).ravel() for m in rows["more"]]
    return np.concatenate(hashes), np.concatenate(more), [len(h) for h in hashes]


def _parted(flags: np.ndarray, sizes: list[int]) -> list[bytes]:
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    return [flags[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]


def _judged(
    sent: DataFrame, units: int, count: int, levels: list[int], judge: Callable[..., np.ndarray], extra: str, short: bool
) -> DataFrame:
    """``(unit, slot, flags)`` for every row of ``sent``, whose slots are those of the first level.

    About ``units`` units send to any one slot.
    """
    if len(levels) == 1:

        def answer(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("unit")
            hashes, more, sizes = _opened(rows, extra, short)
            flags = judge(hashes, more, np.repeat(np.arange(len(rows)), sizes)).astype(np.uint8)
            return pd.DataFrame({"unit": rows["unit"].to_numpy(), "slot": rows["slot"].to_numpy(), "flags": _parted(flags, sizes)})

        return sent.groupBy("slot").applyInPandas(answer, ANSWERED)

    # About FANOUT units meet in a chunk, so that what is merged for a slot is of a unit's size again.
    chunks = max(1, -(-units // FANOUT))
    sent = stored(sent.withColumn("chunk", F.pmod(F.xxhash64("unit"), F.lit(chunks)).cast("long")))

    def merged(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray, list[int]]:
        rows = rows.sort_values("unit")
        hashes, more, sizes = _opened(rows, extra, False)
        return rows, hashes, more, np.argsort(hashes, kind="stable"), sizes

    def onward(rows: pd.DataFrame) -> pd.DataFrame:
        unit = int(rows["slot"].iloc[0]) * chunks + int(rows["chunk"].iloc[0])
        _, hashes, more, order, _ = merged(rows)
        return _cut(unit, hashes[order], more[order], count, levels[1], short and len(levels) == 2)

    def back(rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        rows, hashes, _, order, sizes = merged(rows)
        flags = np.empty(len(hashes), dtype=np.uint8)
        flags[order] = np.frombuffer(b"".join(told.sort_values("slot")["flags"]), dtype=np.uint8)
        return pd.DataFrame({"unit": rows["unit"].to_numpy(), "slot": rows["slot"].to_numpy(), "flags": _parted(flags, sizes)})

    told = _judged(sent.groupBy("slot", "chunk").applyInPandas(onward, SENT), chunks, count, levels[1:], judge, extra, short)
    told = told.select(
        (F.col("unit") % chunks).alias("to_chunk"), F.floor(F.col("unit") / chunks).cast("long").alias("to_slot"), "slot", "flags"
    )
    return sent.groupBy("slot", "chunk").cogroup(told.groupBy("to_slot", "to_chunk")).applyInPandas(back, ANSWERED)


def finished(held: DataFrame, result: Callable[..., pa.RecordBatch], schema: str) -> DataFrame:
    """The rows of ``result(texts, *told)`` for every batch."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in incoming:
            for row in _each(rows):
                yield result(_open(row), *_told(row))

    return held.mapInArrow(run, schema)
