"""Naming columns and telling their roles from the schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """The name in backticks, so that dots and spaces in it mean nothing."""
    return "`" + name.replace("`", "``") + "`"


def unused(columns: Iterable[str], name: str) -> str:
    """The name, with underscores in front until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def named(name: str) -> Column:
    """Column of exactly this name."""
    return F.col(quoted(name))


def categorical_columns(schema: T.StructType, exclude: Iterable[str] = ()) -> list[str]:
    """String columns, in schema order."""
    skip = set(exclude)
    return [f.name for f in schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def numeric_columns(schema: T.StructType, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric and boolean columns, in schema order."""
    skip, kinds = set(exclude), (T.NumericType, T.BooleanType)
    return [f.name for f in schema if isinstance(f.dataType, kinds) and f.name not in skip]
