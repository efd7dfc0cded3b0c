"""Incremental ingestion of arriving files into a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.streaming.upsert import UpsertTable

# Where Spark tells a batch which streaming query it belongs to; the id lives in the checkpoint.
QUERY_ID = "sql.streaming.queryId"


def ingest_available(stream: DataFrame, table: UpsertTable, checkpoint: str) -> None:
    """Drain the files that have arrived into the table, then stop.

    Returns when the last batch is committed. The checkpoint remembers which files
    were taken, so a further run handles only new ones.
    """

    def absorb(batch: DataFrame, batch_id: int) -> None:
        table.apply(batch, batch_id, batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID) or "")

    query = (
        stream.writeStream.outputMode("append")
        .foreachBatch(absorb)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
