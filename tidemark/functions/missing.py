"""The "is missing" predicate, chosen by data type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import types as T

from pyspark.sql import functions as F

from tidemark.functions.columns import named

# Strings that count as missing.
MISSING_STRINGS = ("", "NULL", "null")


def is_missing(field: T.StructField) -> Column:
    """NULL for every type; also NaN for floating types and blank markers for strings."""
    column = named(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    if isinstance(field.dataType, T.StringType):
        return column.isNull() | column.isin(*MISSING_STRINGS)
    return column.isNull()
