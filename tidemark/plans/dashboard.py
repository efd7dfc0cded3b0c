"""The dashboard: a binned, published table and its panels."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions import BinSpec
from tidemark.operators import dashboard, derive
from tidemark.sinks import publish_location, save
from tidemark.sources.batch import read_catalog_table


@dataclass(frozen=True)
class DashboardColumns:
    """Which columns play the dashboard's roles."""

    label: str = "Churn"
    age: str = "Age"
    tenure: str = "Tenure"
    tenure_group: str = "Tenure_category"
    usage: str = "Usage_Frequency"
    support_calls: str = "Support_Calls"
    payment_delay: str = "Payment_Delay"
    spend: str = "Total_Spend"
    subscription: str = "Subscription_Type"
    contract: str = "Contract_Length"


def publish_dashboard(
    spark: SparkSession, processed: DataFrame, bins: Sequence[BinSpec], path: str, name: str
) -> DataFrame:
    """Write the binned table to ``path``, publish it there as ``name`` and return it."""
    save(derive.bin_columns(processed, bins), path)
    publish_location(spark, name, path)
    return read_catalog_table(spark, name)


def dashboard_panels(
    table: DataFrame, columns: DashboardColumns | None = None
) -> dict[str, DataFrame]:
    """One lazy DataFrame per panel."""
    c = columns or DashboardColumns()
    averages = {
        "avg_age": c.age,
        "avg_tenure": c.tenure,
        "avg_usage": c.usage,
        "avg_support_calls": c.support_calls,
        "avg_payment_delay": c.payment_delay,
        "avg_spend": c.spend,
    }
    return {
        "kpi_metrics": dashboard.kpi_metrics(table, c.label, c.tenure, c.spend),
        "churn_distribution": dashboard.label_counts(table, c.label),
        "churn_by_subscription": dashboard.label_counts(table, c.label, c.subscription),
        "churn_by_contract": dashboard.label_counts(table, c.label, c.contract),
        "churn_by_tenure": dashboard.label_counts(table, c.label, c.tenure),
        "churn_by_tenure_group": dashboard.label_counts(table, c.label, c.tenure_group),
        "churn_by_support_calls": dashboard.label_counts(
            table, c.label, c.support_calls, ordered=True
        ),
        "churn_by_usage": dashboard.label_counts(table, c.label, c.usage),
        "avg_by_churn": dashboard.averages_by_label(table, c.label, averages),
    }
