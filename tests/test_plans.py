import pytest

from tidemark.defaults import TENURE_BINS, CleanConfig, FeatureConfig, TrainConfig
from tidemark.functions import BinSpec
from tidemark.operators import registry
from tidemark.plans import (
    DashboardColumns,
    Home,
    dashboard_panels,
    publish_dashboard,
    score_with_champion,
    train_and_promote,
)
from tidemark.workload.tables import customer_360

SF = "/root/testdata/sf0.001"
CLEAN = CleanConfig(dropna=("total_spend", "payment_delay"))
FEATURE = FeatureConfig(key="customer_id", label="churn", bins=(BinSpec("tenure", TENURE_BINS),))


@pytest.fixture(scope="module")
def customers(spark):
    rows = customer_360(spark, SF).cache()
    yield rows
    rows.unpersist()


def test_train_promote_infer(spark, tmp_path, customers):
    home = Home(str(tmp_path))
    first = train_and_promote(
        spark, customers, home, "churn", CLEAN, FEATURE, TrainConfig("dtc", {"maxDepth": [2, 3]})
    )
    assert first.promoted
    assert set(first.metrics) == {
        "accuracy", "weightedPrecision", "weightedRecall", "f1", "areaUnderROC", "areaUnderPR",
    }
    second = train_and_promote(
        spark, customers, home, "churn", CLEAN, FEATURE, TrainConfig("dtc", {"maxDepth": [2, 3]}),
        partitions=["region"],
    )
    # The same data and seed give the same score, which is no improvement.
    assert second.metrics == pytest.approx(first.metrics) and not second.promoted
    versions = spark.read.schema(registry.REGISTRY).parquet(home.registry).collect()
    assert [(r["version"], r["run_id"]) for r in versions] == [(1, first.run_id)]

    unlabelled = customers.drop("churn")
    scored = score_with_champion(spark, unlabelled, home, "churn", CLEAN, FEATURE)
    rows = scored.collect()
    assert len({r["customer_id"] for r in rows}) == len(rows) > 0
    assert {r["prediction"] for r in rows} <= {0.0, 1.0}
    with pytest.raises(LookupError):
        score_with_champion(spark, unlabelled, home, "other", CLEAN, FEATURE)


def test_training_without_the_key_column(spark, tmp_path, customers):
    cleaning = CleanConfig(drop=("customer_id",), dropna=("total_spend",))
    home = Home(str(tmp_path))
    result = train_and_promote(
        spark, customers, home, "churn", cleaning, FEATURE, TrainConfig("lr")
    )
    assert result.promoted
    assert score_with_champion(spark, customers, home, "churn", cleaning, FEATURE).count() > 0


def test_dashboard(spark, tmp_path, customers):
    table = publish_dashboard(
        spark, customers, [BinSpec("tenure", TENURE_BINS)], str(tmp_path), "tm_dashboard"
    )
    panels = dashboard_panels(
        table,
        DashboardColumns(
            label="churn", age="balance", tenure="tenure", tenure_group="tenure_category",
            usage="usage_frequency", support_calls="support_calls", payment_delay="payment_delay",
            spend="total_spend", subscription="segment", contract="region",
        ),
    )
    total = customers.count()
    assert panels["kpi_metrics"].first()["total_customers"] == total
    for name, panel in panels.items():
        if name.startswith("churn_"):
            assert sum(r["count"] for r in panel.collect()) == total, name
    assert panels["avg_by_churn"].count() == 2
    spark.sql("DROP TABLE tm_dashboard")
