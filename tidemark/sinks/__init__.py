"""Batch sinks."""

from tidemark.sinks.batch import (
    publish_location,
    publish_table,
    save,
    save_counted,
    save_if_absent,
)

__all__ = ["publish_location", "publish_table", "save", "save_counted", "save_if_absent"]
