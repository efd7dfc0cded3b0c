"""Dashboard aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import named, percent


def kpi_metrics(df: DataFrame, label: str, tenure: str, spend: str) -> DataFrame:
    """Customers, churned customers, churn rate in percent, mean tenure and spend."""
    total = F.count(F.lit(1))
    churned = F.count_if(named(label) == 1)
    return df.agg(
        total.alias("total_customers"),
        churned.alias("churned_customers"),
        F.round(percent(churned, total), 2).alias("churn_rate"),
        F.round(F.avg(named(tenure)), 2).alias("avg_tenure"),
        F.round(F.avg(named(spend)), 2).alias("avg_spend"),
    )


def label_counts(df: DataFrame, label: str, *keys: str, ordered: bool = False) -> DataFrame:
    """Rows per label value, or per key and label value."""
    columns = [*keys, label]
    counts = df.groupBy(*[named(c) for c in columns]).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(*[named(c) for c in columns]) if ordered else counts


def averages_by_label(df: DataFrame, label: str, measures: Mapping[str, str]) -> DataFrame:
    """Mean of each measure per label value; ``measures`` maps output name to column."""
    return df.groupBy(named(label)).agg(
        *[F.avg(named(column)).alias(name) for name, column in measures.items()]
    )


def label_counts_all(df: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """Counts for several keys at once, as rows ``(panel, value, label, count)``.

    Feeds all count panels of a dashboard from one scan and one shuffle.
    """
    return (
        df.select(named(label).alias(label), *[named(k).cast("string").alias(k) for k in keys])
        .unpivot([named(label)], [named(k) for k in keys], "panel", "value")
        .groupBy("panel", "value", named(label))
        .agg(F.count(F.lit(1)).alias("count"))
    )
