"""Derived columns: bins, ratios, engagement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.defaults import (
    AGE_BEYOND,
    AGE_STEPS,
    BALANCE_BEYOND,
    BALANCE_STEPS,
    BALANCE_ZERO,
    SCORE_BEYOND,
    SCORE_STEPS,
    TENURE_BEYOND,
    TENURE_STEPS,
)
from tidemark.functions import BinSpec, bin_expression, guarded_ratio, named, step_expression


def bin_columns(df: DataFrame, specs: Sequence[BinSpec] = ()) -> DataFrame:
    """Adds ``<column>_category`` for each spec; the input itself when there is none."""
    if not specs:
        return df
    return df.withColumns({s.output: bin_expression(s.column, s.labels) for s in specs})


def bin_age(df: DataFrame, column: str = "age", output: str = "age_category") -> DataFrame:
    """Young below 40, Middle-Aged below 65, else Senior (also NULL)."""
    return df.withColumn(output, step_expression(named(column), AGE_STEPS, AGE_BEYOND))


def bin_balance(
    df: DataFrame, column: str = "balance", output: str = "balance_category"
) -> DataFrame:
    """Zero at 0, Low below 50,000, Medium below 100,000, else High (also NULL)."""
    value = named(column)
    rest = step_expression(value, BALANCE_STEPS, BALANCE_BEYOND)
    return df.withColumn(output, F.when(value == 0, BALANCE_ZERO).otherwise(rest))


def bin_score(
    df: DataFrame, column: str = "credit_score", output: str = "credit_score_category"
) -> DataFrame:
    """Poor below 600, Fair below 700, Good below 800, else Excellent (also NULL)."""
    return df.withColumn(output, step_expression(named(column), SCORE_STEPS, SCORE_BEYOND))


def bin_tenure(df: DataFrame, column: str = "tenure", output: str = "tenure_category") -> DataFrame:
    """New to 3, Early-Stage to 12, Mid-term to 24, else Loyal (also NULL)."""
    label = step_expression(named(column), TENURE_STEPS, TENURE_BEYOND, inclusive=True)
    return df.withColumn(output, label)


def ratio_column(df: DataFrame, numerator: str, divisor: str) -> DataFrame:
    """Adds ``<numerator>_<divisor>_ratio``; a zero divisor counts as 1."""
    return df.withColumn(
        f"{numerator}_{divisor}_ratio", guarded_ratio(named(numerator), named(divisor))
    )


def engagement_score(
    df: DataFrame,
    adoption: str = "adoption",
    stickiness: str = "stickiness",
    growth: str = "growth",
) -> DataFrame:
    """Adds ``engagement_score``, the product of the three inputs."""
    return df.withColumn("engagement_score", named(adoption) * named(stickiness) * named(growth))
