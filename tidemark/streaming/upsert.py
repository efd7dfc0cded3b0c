"""Keyed upsert: as a DataFrame operator, and as a table fed batch by batch."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import named, quoted, unused
from tidemark.operators.clean import first_per_key
from tidemark.sources.files_stream import store_schema, stored_schema
from tidemark.sources.storage import delete, is_committed, list_names


def _has_key(key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [named(k).isNotNull() for k in key])


def latest_per_key(
    df: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Last row of each key in the order; rows without a key are all kept.

    Without an order a key may occur only once, and a second row raises when the
    result is computed. The source is read once: a row without a key gets a number of its
    own beside the key, so such rows neither compete nor meet in one task.
    """
    own = unused(df.columns, "_own")
    numbered = df.withColumn(own, F.when(~_has_key(key), F.monotonically_increasing_id()))
    keys = [*key, own]
    if order_by:
        return first_per_key(numbered, keys, order_by, descending=True).drop(own)
    rank = unused(numbered.columns, "_rank")
    order = Window.partitionBy(*[named(k) for k in keys]).orderBy(*[named(k) for k in keys])
    repeated = F.raise_error(F.lit(f"several rows for one key {list(key)} in a batch"))
    return (
        numbered.withColumn(rank, F.row_number().over(order))
        .where(named(rank) <= 2)
        .where(F.when(named(rank) == 2, repeated.cast("boolean")).otherwise(F.lit(True)))
        .drop(rank, own)
    )


def replace_keys(target: DataFrame, fresh: DataFrame, key: Sequence[str]) -> DataFrame:
    """``fresh`` rows, and the target rows whose key is not among them.

    NULL keys match nothing, so such rows of both sides are kept. How the keys reach the
    target is left to Spark's size statistics and adaptive execution.
    """
    keys = fresh.where(_has_key(key)).select(*[named(k) for k in key])
    kept = target.join(keys, list(key), "left_anti")
    return kept.select(*[named(c) for c in target.columns]).unionByName(fresh)


def upsert(
    target: DataFrame, source: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Source rows replace target rows of the same key in all columns; others are kept."""
    return replace_keys(target, latest_per_key(source, key, order_by), key)


# Names of the partition columns that a table's folders are made of.
PART, BUCKET = "tidemark_part", "tidemark_bucket"
# Hash buckets of a table's keys unless told otherwise; a bucket should come to about a file's size.
BUCKETS = 16


@dataclass(frozen=True)
class UpsertTable:
    """A keyed table that absorbs batches without rewriting itself, kept in hash buckets of its key.

    A batch is written once, reduced to its last row per key, as a change numbered over all
    batches of the table. Full copies and changes lie in the same buckets of Spark's own bucketing,
    so reading merges them bucket by bucket: neither side is moved, and the newest change of a
    key replaces its row in the copy. ``compact`` folds changes into new copies of the buckets that they
    touch and leaves the files of all others alone; it is called between batches, never from
    inside one. Rows without a key replace nothing; they lie apart, outside the buckets.

    Below ``path``: ``base/`` and ``changes/``, each with a folder per part and in it one per
    bucket, ``loose/`` for rows without a key, and ``schemas/``. A part counts once Spark has marked it complete; of
    a bucket's copies the newest counts.

    A batch is known by its stream and its id. The same batch again, after a failure,
    changes nothing; a batch of another stream, also of one whose checkpoint was lost, is a
    new change. One writer at a time.

    Columns that a batch adds are taken up, NULL in the rows before; a batch that lacks a
    known column or changes its type raises before anything is written. A table keeps the number of
    buckets that it began with; another one raises.
    """

    path: str
    key: tuple[str, ...]
    order_by: tuple[str, ...] = ()
    fmt: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    buckets: int = BUCKETS

    def _part_path(self, kind: str, part: object) -> str:
        return f"{self.path}/{kind}/{PART}={part}"

    def _loose_path(self, name: str) -> str:
        return f"{self.path}/loose/{name}"

    def _schema_path(self, name: str) -> str:
        return f"{self.path}/schemas/{name}"

    def _parts(self, spark: SparkSession, kind: str) -> list[str]:
        """Names of the complete parts."""
        names = [n.removeprefix(f"{PART}=") for n in list_names(spark, f"{self.path}/{kind}") if n.startswith(f"{PART}=")]
        return [n for n in names if is_committed(spark, self._part_path(kind, n))]

    def _bases(self, spark: SparkSession) -> list[int]:
        return sorted(int(n) for n in self._parts(spark, "base"))

    def _changes(self, spark: SparkSession) -> list[tuple[int, str, int, str]]:
        """``(number, name, batch id, stream)`` of the complete changes, in order."""
        found = []
        for name in self._parts(spark, "changes"):
            number, batch, stream = re.fullmatch(r"(\d+)-(-?\d+)-([0-9a-f]+)", name).groups()
            found.append((int(number), name, int(batch), stream))
        return sorted(found)

    def _buckets_of(self, spark: SparkSession, kind: str, part: object) -> list[int]:
        names = list_names(spark, self._part_path(kind, part))
        return sorted(int(n.removeprefix(f"{BUCKET}=")) for n in names if n.startswith(f"{BUCKET}="))

    def _live(self, spark: SparkSession) -> dict[int, int]:
        """The newest copy of each bucket."""
        return {b: n for n in self._bases(spark) for b in self._buckets_of(spark, "base", n)}

    def _check_buckets(self, spark: SparkSession) -> None:
        names = [n.removeprefix("buckets=") for n in list_names(spark, f"{self.path}/layout")]
        if not names:
            empty = spark.createDataFrame([], "n int")
            empty.write.mode("overwrite").parquet(f"{self.path}/layout/buckets={self.buckets}")
        elif names != [str(self.buckets)]:
            raise ValueError(f"the table at {self.path} has {names[0]} buckets, not {self.buckets}")

    def _table(self, spark: SparkSession, kind: str, schema: T.StructType) -> DataFrame:
        """All parts of a kind as one bucketed table.

        Only a catalog can tell Spark of buckets, so there is an entry for each path and schema
        that was read. It owns no files; dropping it loses nothing.
        """
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
        keys = ", ".join(quoted(k) for k in self.key)
        options = {**self.options, "path": f"{self.path}/{kind}"}
        definition = (
            f"({columns}, {PART} string, {BUCKET} int) USING {self.fmt} "
            f"OPTIONS ({', '.join(f'{_literal(k)} {_literal(v)}' for k, v in options.items())}) "
            f"PARTITIONED BY ({PART}, {BUCKET}) CLUSTERED BY ({keys}) INTO {self.buckets} BUCKETS"
        )
        name = f"tidemark_{hashlib.md5(definition.encode()).hexdigest()}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {definition}")
        # Folders that have come since.
        spark.catalog.recoverPartitions(name)
        return spark.read.table(name)

    def _write(self, rows: DataFrame, kind: str, part: object) -> None:
        """Write rows that have a key as a part, each task one bucket's."""
        path, spark = self._part_path(kind, part), rows.sparkSession
        # What a failed attempt left; Spark would not write into it.
        delete(spark, path)
        name = f"tidemark_{uuid.uuid4().hex}"
        bucket = F.pmod(F.hash(*[named(k) for k in self.key]), F.lit(self.buckets))
        writer = rows.withColumn(BUCKET, bucket).write.format(self.fmt).options(**self.options)
        writer = writer.partitionBy(BUCKET).bucketBy(self.buckets, *self.key).option("path", path)
        try:
            writer.saveAsTable(name)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    def schema(self, spark: SparkSession) -> T.StructType | None:
        """Columns of the newest change, which has all that earlier ones have; None for no table."""
        changes = self._changes(spark)
        return stored_schema(spark, self._schema_path(changes[-1][1])) if changes else None

    def _fresh(self, spark: SparkSession, schema: T.StructType, names: list[str]) -> DataFrame:
        """Newest change of each key, bucket by bucket."""
        changes = self._table(spark, "changes", schema).where(F.col(PART).isin(names))
        number = unused(schema.names, "_number")
        if len(names) == 1:
            # A change holds each key once.
            return changes.select(*[named(c) for c in schema.names])
        came = F.split_part(F.col(PART), F.lit("-"), F.lit(1)).cast("bigint")
        numbered = changes.select(*[named(c) for c in schema.names], came.alias(number))
        return first_per_key(numbered, self.key, [number], descending=True).drop(number)

    def _copies(self, spark: SparkSession, schema: T.StructType, live: dict[int, int]) -> DataFrame:
        """The copies of the given buckets; folders of all others are not even listed as input."""
        parts: dict[int, list[int]] = {}
        for bucket, part in live.items():
            parts.setdefault(part, []).append(bucket)
        chosen = [(F.col(PART) == str(part)) & F.col(BUCKET).isin(held) for part, held in parts.items()]
        base = self._table(spark, "base", schema).where(reduce(lambda a, b: a | b, chosen))
        return base.select(*[named(c) for c in schema.names])

    def _keyed(self, spark: SparkSession, schema: T.StructType, live: dict[int, int], names: list[str]) -> DataFrame | None:
        """Current rows with a key: copies of ``live`` buckets and the changes in ``names``."""
        copies = self._copies(spark, schema, live) if live else None
        fresh = self._fresh(spark, schema, names) if names else None
        if copies is None or fresh is None:
            return copies if fresh is None else fresh
        keys = fresh.select(*[named(k) for k in self.key])
        return copies.join(keys, list(self.key), "left_anti").select(*copies.columns).unionByName(fresh)

    def _pending(self, spark: SparkSession) -> list[str]:
        """Names of the changes that no copy holds yet, those without a keyed row left out."""
        newest = max(self._bases(spark), default=-1)
        names = [name for n, name, _, _ in self._changes(spark) if n > newest]
        return [name for name in names if self._buckets_of(spark, "changes", name)]

    def read(self, spark: SparkSession) -> DataFrame:
        """Current rows."""
        schema = self.schema(spark)
        if schema is None:
            raise ValueError(f"no committed table at {self.path}")
        keyed = self._keyed(spark, schema, self._live(spark), self._pending(spark))
        apart = [self._loose_path(name) for _, name, _, _ in self._changes(spark)]
        apart = [p for p in apart if is_committed(spark, p)]
        # The schema is given, since older files lack columns that came later.
        loose = spark.read.format(self.fmt).options(**self.options).schema(schema).load(apart) if apart else None
        if keyed is None or loose is None:
            return loose if keyed is None else keyed
        return keyed.unionByName(loose)

    def _conformed(self, batch: DataFrame, known: T.StructType | None) -> DataFrame:
        have = {f.name: f.dataType.simpleString() for f in batch.schema}
        lost = [c for c in (*self.key, *self.order_by) if c not in have]
        lost += [f.name for f in known or () if f.name not in have]
        changed = [f.name for f in known or () if have.get(f.name, f.dataType.simpleString()) != f.dataType.simpleString()]
        if lost or changed:
            raise ValueError(f"batch for {self.path}: columns missing {lost}, of another type {changed}")
        if {PART, BUCKET} & {c.lower() for c in have}:
            raise ValueError(f"{PART} and {BUCKET} are names of the table's own")
        names = [f.name for f in known or ()]
        return batch.select(*[named(c) for c in [*names, *[c for c in batch.columns if c not in names]]])

    def apply(self, batch: DataFrame, batch_id: int, stream: str = "") -> None:
        """Absorb one batch of a stream."""
        spark = batch.sparkSession
        tag = hashlib.md5(stream.encode()).hexdigest()
        changes = self._changes(spark)
        if any((b, s) == (batch_id, tag) for _, _, b, s in changes):
            return
        self._check_buckets(spark)
        rows = self._conformed(batch, self.schema(spark))
        number = max([*self._bases(spark), *[n for n, *_ in changes]], default=-1) + 1
        name = f"{number}-{batch_id}-{tag}"
        store_schema(spark, rows.schema, self._schema_path(name))
        # The rows without a key before the others: a change counts once its keyed rows are complete.
        loose = rows.where(~_has_key(self.key))
        loose.write.format(self.fmt).options(**self.options).mode("overwrite").save(self._loose_path(name))
        latest = latest_per_key(rows.where(_has_key(self.key)), self.key, self.order_by)
        self._write(latest.repartition(self.buckets, *[named(k) for k in self.key]), "changes", name)

    def compact(self, spark: SparkSession) -> bool:
        """Fold all changes into new copies of the buckets they touch; False when there are none."""
        names = self._pending(spark)
        if not names:
            return False
        touched = {b for name in names for b in self._buckets_of(spark, "changes", name)}
        live = {b: n for b, n in self._live(spark).items() if b in touched}
        newest = max(n for n, *_ in self._changes(spark))
        self._write(self._keyed(spark, self.schema(spark), live, names), "base", newest)
        return True

    def expire(self, spark: SparkSession) -> list[str]:
        """Delete copies of buckets that have a newer one, and the changes folded into them.

        The last batch of each stream stays, since Spark may deliver it again, and so do rows
        without a key. Call it between batches, when no reader still uses an older copy.
        """
        bases, live = self._bases(spark), self._live(spark)
        newest = max(bases, default=-1)
        last = {s: b for b, s in sorted((b, s) for _, _, b, s in self._changes(spark))}
        old = []
        for n in bases:
            held = self._buckets_of(spark, "base", n)
            stale = [b for b in held if live[b] != n]
            if n < newest and len(stale) == len(held):
                old.append(self._part_path("base", n))
            else:
                old += [f"{self._part_path('base', n)}/{BUCKET}={b}" for b in stale]
        for n, name, b, s in self._changes(spark):
            if n <= newest and b < last[s]:
                held = self._buckets_of(spark, "changes", name)
                old += [f"{self._part_path('changes', name)}/{BUCKET}={k}" for k in held]
        return [p for p in old if delete(spark, p)]


def _literal(text: str) -> str:
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"
