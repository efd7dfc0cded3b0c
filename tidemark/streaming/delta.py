"""Keyed upsert into a Delta table, for sessions that have the Delta extension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.sinks import save_if_absent
from tidemark.sources.storage import exists
from tidemark.streaming.upsert import latest_per_key


def merge_statement(path: str, key: tuple[str, ...], source: str) -> str:
    """MERGE that updates all columns of matched keys and inserts the others."""
    match = " AND ".join(f"target.`{k}` = source.`{k}`" for k in key)
    return (
        f"MERGE INTO delta.`{path}` AS target USING {source} AS source ON {match} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


@dataclass(frozen=True)
class DeltaUpsertTable:
    """Same use as ``UpsertTable``; Delta keeps versions and rewrites only touched files."""

    path: str
    key: tuple[str, ...]
    order_by: tuple[str, ...] = ()

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("delta").load(self.path)

    def apply(self, batch: DataFrame, batch_id: int, stream: str = "") -> None:
        """Absorb one batch; merging it again changes nothing."""
        spark = batch.sparkSession
        rows = latest_per_key(batch, self.key, self.order_by)
        if exists(spark, f"{self.path}/_delta_log"):
            rows.createOrReplaceTempView("tidemark_batch")
            spark.sql(merge_statement(self.path, self.key, "tidemark_batch"))
        else:
            save_if_absent(rows, self.path, "delta")
