"""What physical plans must and must not read."""

import re

import pytest

from tidemark.workload.queries import QUERIES

SF = "/root/testdata/sf0.01"
DASHBOARD = [
    "kpi_metrics",
    "churn_distribution",
    "churn_by_segment",
    "churn_by_region",
    "churn_by_tenure",
    "churn_by_tenure_group",
    "churn_by_usage",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tables(plan):
    return set(re.findall(r"/(\w+)\.parquet", plan))


@pytest.mark.parametrize("name", DASHBOARD)
def test_dashboard_leaves_out_the_largest_tables(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "orders" in tables(plan)
    assert not {"lineitem", "events"} & tables(plan)


def test_scans_read_only_needed_columns_and_push_filters(spark):
    plan = plan_of(QUERIES["avg_by_churn"](spark, SF))
    lineitem = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert "[l_orderkey" in lineitem and lineitem.count("l_") and "l_quantity" not in lineitem
    assert "LessThanOrEqual(l_shipdate,2001-02-01" in lineitem
    documents = plan_of(QUERIES["confusion_matrix"](spark, SF))
    assert "text" not in next(line for line in documents.splitlines() if "documents.parquet" in line)


@pytest.mark.parametrize("name", ["null_profile", "describe", "corr_with_label", "corr_matrix"])
def test_profiles_scan_each_table_once(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for large in ("lineitem", "orders", "customer"):
        assert plan.count(f"/{large}.parquet") == 1


@pytest.mark.parametrize("name", ["rate_by_category", "churn_panels"])
def test_several_categories_share_one_scan(spark, name):
    assert plan_of(QUERIES[name](spark, SF)).count("/orders.parquet") == 1


def test_engagement_branches_share_scans_of_the_log(spark):
    result = QUERIES["engagement_inputs"](spark, SF)
    result.collect()
    plan = plan_of(result).split("Initial Plan")[0]
    assert plan.count("/events.parquet") <= 2
