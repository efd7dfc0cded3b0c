"""Guarded arithmetic and pairwise statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_ratio(numerator: Column, divisor: Column) -> Column:
    """Quotient as double in which a zero divisor counts as 1."""
    return numerator.cast("double") / F.when(divisor == 0, F.lit(1)).otherwise(divisor)


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent; NULL for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100.0


def pairwise_corr(x: Column, y: Column, nulls_as_zero: bool = False) -> Column:
    """Pearson correlation over the rows where both sides are present, that is not NULL or NaN.

    NULL when either side does not vary. ``F.corr`` divides by zero there, which
    ANSI mode turns into an error, so the quotient is formed from the moments.
    """
    if nulls_as_zero:
        a = F.coalesce(x.cast("double"), F.lit(0.0))
        b = F.coalesce(y.cast("double"), F.lit(0.0))
    else:
        nothing = F.lit(None).cast("double")
        left, right = (F.nanvl(side.cast("double"), nothing) for side in (x, y))
        both = left.isNotNull() & right.isNotNull()
        a, b = F.when(both, left), F.when(both, right)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
