"""Quality by nearest-neighbour voting in a latent-semantic space.

A text becomes a vector of term weights: hashed character trigrams of its *shape*
(letters, digits and punctuation by class, so that a new vocabulary or language has the
same terms) and pseudo-terms for how often words repeat. A bounded sample of labelled
texts fixes term weights and the latent space (truncated SVD). Each text of the corpus
is projected, its cosine with every labelled vector is computed in blocks, and its
nearest neighbours vote with their similarity.

Null and empty texts have no terms; they get the prior, the share of good texts in the
sample. Rows keep their order and number; ids may repeat or be null. Labels that are
null take no part; a text with several labels counts as good if most of them say so, and as bad
if they are split. Without any labelled text every score is 0.5.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bytes_of, slices, texts_of

# Most labelled texts that the classifier is fitted on, half from each label if there are.
SAMPLE = 3000
TERMS = 4096
REPEAT_TERMS = 64
DIMENSIONS = 48
NEIGHBOURS = 15
THRESHOLD = 0.3
BLOCK = 2048
# Names that no column of a table has.
_BYTES, _SCORE = "__bytes_of_text", "__quality_score"

_CLASSES = np.arange(256, dtype=np.uint8)
for _i in range(256):
    _c = chr(_i)
    _CLASSES[_i] = (
        ord("a") if _i >= 128 or _c.islower() else ord("A") if _c.isupper() else ord("0") if _c.isdigit() else _i
    )
_SHAPE = _CLASSES.tobytes()


def terms(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Term ids and counts of one whole text."""
    if not text.strip():
        return np.empty(0, np.int64), np.empty(0)
    shape = np.frombuffer(b" " + text.translate(_SHAPE) + b" ", dtype=np.uint8).astype(np.uint32)
    code = (shape[:-2] << 16) | (shape[1:-1] << 8) | shape[2:]
    slot = (code * np.uint32(2654435761)) >> np.uint32(20)
    counts = np.bincount(slot, minlength=TERMS).astype(float)
    found = np.flatnonzero(counts)
    words = text.lower().split()
    # Shares of words that repeat their predecessor, and of different words per 64.
    same = sum(a == b for a, b in zip(words, words[1:])) / len(words)
    parts = [words[i : i + 64] for i in range(0, len(words), 64)]
    varied = sum(len(set(p)) for p in parts) / len(words)
    extra = np.array([same, 1 - varied])
    levels = TERMS + np.arange(2) * (REPEAT_TERMS // 2) + np.minimum(extra * 8, 7).astype(int)
    return np.concatenate((found, levels)), np.concatenate((counts[found], np.full(2, len(text) / 8)))


def _damped(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Term ids and damped weights of one whole text."""
    found, counts = terms(text)
    return found, np.sqrt(counts).astype(np.float32)


def _dense(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term ids and weights as dense rows, and which rows have any."""
    out = np.zeros((len(rows), TERMS + REPEAT_TERMS), dtype=np.float32)
    for i, (found, weights) in enumerate(rows):
        out[i, found] = weights
    return out, out.any(axis=1)


def _rows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return _dense([_damped(t) for t in texts])


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


@dataclass
class Model:
    weights: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    neighbours: int = NEIGHBOURS

    def score(self, texts: list[bytes]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        if not len(self.labels):
            return out
        for start in range(0, len(texts), BLOCK):
            raw, some = _rows(texts[start : start + BLOCK])
            near = _unit((_unit(raw) * self.weights) @ self.space) @ self.vectors.T
            k = min(self.neighbours, near.shape[1])
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            # A steep power of the cosine: what is nearly the same outvotes what is merely close.
            vote = np.clip(np.take_along_axis(near, best, axis=1), 1e-3, 1).astype(float) ** 16
            share = (vote * self.labels[best]).sum(axis=1) / vote.sum(axis=1)
            out[start : start + BLOCK] = np.where(some, share, self.prior)
        return np.clip(out, 0, 1)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], prior: float, dimensions: int = DIMENSIONS) -> Model:
    """Term weights, latent space and labelled vectors of the sample, given as term ids and weights."""
    raw, some = _dense(rows)
    raw, labels = raw[some], np.asarray(labels, dtype=float)[some]
    if not len(raw):
        return Model(np.ones(1), np.ones((1, 1)), np.ones((0, 1)), labels, prior)
    weights = np.log((1 + len(raw)) / (1 + (raw > 0).sum(axis=0))).astype(np.float32) + 0.2
    # In place, and by subspace iteration: the sample's rows are the largest thing held here.
    raw /= np.linalg.norm(raw, axis=1, keepdims=True)
    raw *= weights
    space = np.random.default_rng(0).standard_normal((raw.shape[1], dimensions + 8)).astype(np.float32)
    for _ in range(40):
        space, _ = np.linalg.qr(raw.T @ (raw @ space))
    small = raw @ space
    _, turn = np.linalg.eigh(small.T @ small)
    space = (space @ turn[:, ::-1][:, :dimensions]).astype(np.float32)
    return Model(weights, space, _unit(raw @ space).astype(np.float32), labels, prior)


def train(docs: DataFrame, labels: DataFrame, train_on: Column, sample: int = SAMPLE) -> Model:
    """A model from at most ``sample`` labelled texts, picked by hash, half from each label.

    The sample is bounded by its parameter, and its texts become terms where they are: at most
    ``TERMS`` numbers a text, however long, come to the driver.
    """
    # Conflicting labels: the majority, and 0 if they are split.
    known = labels.where(train_on & F.col("quality").isin(0, 1)).groupBy("doc_id")
    known = known.agg((F.avg("quality") > 0.5).cast("int").alias("quality"))
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    good, bad = counts.get(1, 0), counts.get(0, 0)
    prior = good / (good + bad) if good + bad else 0.5
    picked = None
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit("quality"))
    for label in (0, 1):
        part = known.where(F.col("quality") == label).orderBy(order, "doc_id").limit(sample // 2)
        picked = part if picked is None else picked.unionByName(part)
    # At most `sample` ids, so this side is bounded whatever the corpus.
    found = bytes_of(docs, "doc_id").join(F.broadcast(picked), "doc_id")
    bounded = found.groupBy("doc_id").agg(F.first("quality").alias("quality"), F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = [_damped(t) for t in texts_of(part)]
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        part.column("quality"),
                        pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())),
                        pa.array([r[1] for r in rows], pa.list_(pa.float32())),
                    ],
                    ["doc_id", "quality", "found", "weights"],
                )

    kind = bounded.schema["doc_id"].dataType.simpleString()
    sampled = bounded.mapInArrow(run, f"doc_id {kind}, quality int, found array<int>, weights array<float>")
    rows, marks = [], []
    for row in sampled.orderBy("doc_id").toLocalIterator():
        rows.append((np.array(row["found"], dtype=np.int64), np.array(row["weights"], dtype=np.float32)))
        marks.append(int(row["quality"]))
    return fit(rows, marks, prior)


def score(docs: DataFrame, model: Model, columns: list[str], name: str = "score") -> DataFrame:
    """The named columns and the score of every row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    taken = docs.select(*[F.col(f"`{c}`") for c in columns], F.col("text").cast("binary").alias(_BYTES))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in taken.schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = pickle.loads(shared.value)
        for batch in batches:
            for part in slices(batch, _BYTES):
                scores = pa.array(fitted.score(texts_of(part, _BYTES)))
                yield pa.record_batch([*part.columns[:-1], scores], [*columns, name])

    return taken.mapInArrow(run, ", ".join([*fields, f"`{name}` double"]))


def held_out() -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``."""
    model = train(docs, labels, ~held_out(), sample)
    return score(docs, model, ["doc_id"]).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that the classifier does not reject."""
    model = train(docs, labels, ~held_out(), sample)
    scored = score(docs, model, docs.columns, _SCORE)
    return scored.where(F.col(_SCORE) >= THRESHOLD).drop(_SCORE)
