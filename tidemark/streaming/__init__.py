"""Keyed upsert and incremental ingestion."""
