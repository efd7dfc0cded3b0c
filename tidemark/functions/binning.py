"""Labels for ranges of a numeric column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.columns import named


@dataclass(frozen=True)
class BinLabel:
    """One label. An open start means ``< end``, an open end ``> start``, else both ends count."""

    name: str
    start: float | None = None
    end: float | None = None

    def covers(self, value: Column) -> Column:
        if self.start is None:
            return value < self.end
        if self.end is None:
            return value > self.start
        return value.between(self.start, self.end)


@dataclass(frozen=True)
class BinSpec:
    """A column and its labels in order of precedence."""

    column: str
    labels: tuple[BinLabel, ...]

    @property
    def output(self) -> str:
        return f"{self.column}_category"

    @classmethod
    def from_mapping(cls, spec: Mapping) -> BinSpec:
        """From ``{"col_name", "labels": [{"name", "start", "end"}]}``; "null" is an open end."""

        def bound(value):
            return None if value is None or value == "null" else value

        return cls(
            spec["col_name"],
            tuple(
                BinLabel(label["name"], bound(label["start"]), bound(label["end"]))
                for label in spec["labels"]
            ),
        )


def bin_expression(value: str | Column, labels: Sequence[BinLabel]) -> Column:
    """First label that covers the value; NULL when none does."""
    column = named(value) if isinstance(value, str) else value
    return F.coalesce(*[F.when(label.covers(column), F.lit(label.name)) for label in labels])


def step_expression(
    value: Column, steps: Sequence[tuple[float, str]], beyond: str, inclusive: bool = False
) -> Column:
    """Label of the first bound the value is below (or at, if inclusive); ``beyond`` for the
    rest, which takes in NULL."""
    reached = [
        F.when(value <= bound if inclusive else value < bound, F.lit(label))
        for bound, label in steps
    ]
    return F.coalesce(*reached, F.lit(beyond))
