"""The whole flow on the raw column names with spaces, from CSV files to a dashboard."""

import pytest
from pyspark.sql import functions as F

from tidemark.defaults import AGE_BINS, TENURE_BINS, CleanConfig, FeatureConfig, TrainConfig
from tidemark.functions import BinSpec
from tidemark.operators import clean, profile
from tidemark.plans import (
    Home,
    dashboard_panels,
    publish_dashboard,
    score_with_champion,
    train_and_promote,
)
from tidemark.sinks import save
from tidemark.sources.batch import read_csv
from tidemark.sources.files_stream import read_file_stream
from tidemark.streaming.ingest import ingest_available
from tidemark.streaming.upsert import UpsertTable

BINS = (BinSpec("Age", AGE_BINS), BinSpec("Tenure", TENURE_BINS))
CLEAN = CleanConfig(dropna=("Support Calls", "Total Spend", "Payment Delay"))
FEATURE = FeatureConfig(key="CustomerID", label="Churn", bins=BINS)


@pytest.fixture(scope="module")
def raw(spark):
    h = F.xxhash64("id")

    def below(n, shift):
        return F.pmod(F.shiftright(h, shift), F.lit(n)).cast("int")

    calls = below(11, 3)
    return spark.range(1, 401).select(
        F.col("id").cast("int").alias("CustomerID"),
        (below(50, 5) + 18).alias("Age"),
        F.when(below(2, 7) == 0, "Female").otherwise("Male").alias("Gender"),
        (below(60, 9) + 1).alias("Tenure"),
        (below(30, 11) + 1).alias("Usage Frequency"),
        F.when(F.col("id") == 13, None).otherwise(calls).alias("Support Calls"),
        below(31, 13).alias("Payment Delay"),
        F.element_at(F.array(*map(F.lit, ["Basic", "Standard", "Premium"])), below(3, 15) + 1).alias(
            "Subscription Type"
        ),
        F.element_at(F.array(*map(F.lit, ["Monthly", "Quarterly", "Annual"])), below(3, 17) + 1).alias(
            "Contract Length"
        ),
        (below(900, 19) + 100.5).alias("Total Spend"),
        (below(30, 21) + 1).alias("Last Interaction"),
        (calls > 5).cast("int").alias("Churn"),
    )


@pytest.fixture(scope="module")
def ingested(spark, raw, tmp_path_factory):
    home = str(tmp_path_factory.mktemp("lake"))
    save(raw, f"{home}/landing", fmt="csv", header="true")
    source = read_csv(spark, f"{home}/landing")
    assert dict(source.dtypes)["Total Spend"] == "double"
    save(source, f"{home}/arrivals")
    stream = read_file_stream(spark, f"{home}/arrivals", schema_path=f"{home}/schema")
    table = UpsertTable(f"{home}/customers", key=("CustomerID",))
    ingest_available(stream, table, f"{home}/checkpoint")
    return table.read(spark)


def test_ingested_rows(ingested, raw):
    assert ingested.count() == 400
    gaps = {r["column"]: r["null_count"] for r in profile.null_profile(ingested).collect()}
    assert gaps["Support Calls"] == 1 and sum(gaps.values()) == 1
    rates = profile.rate_by_category(ingested, "Churn", ["Gender", "Contract Length"]).collect()
    assert {r["column"] for r in rates} == {"Gender", "Contract Length"}
    top = profile.corr_with_label(ingested, "Churn", ["Age", "Support Calls", "Total Spend"]).first()
    assert top["column"] == "Support Calls"


def test_train_and_score(spark, ingested, tmp_path):
    home = Home(str(tmp_path))
    result = train_and_promote(
        spark, ingested, home, "churn", CLEAN, FEATURE, TrainConfig("gbt", {"maxDepth": [2, 3]}),
        partitions=["Gender", "Subscription Type", "Contract Length"],
    )
    assert result.promoted and result.metrics["accuracy"] > 0.95
    assert spark.read.parquet(home.processed).where("`Contract Length` = 'Annual'").count() > 0
    scored = score_with_champion(spark, ingested.drop("Churn"), home, "churn", CLEAN, FEATURE)
    wrong = scored.join(ingested, "CustomerID").where(F.col("prediction") != F.col("Churn"))
    assert scored.count() == 399 and wrong.count() < 20


def test_dashboard_on_normalised_names(spark, ingested, tmp_path):
    processed = clean.clean(clean.normalise_names(ingested), CleanConfig(drop=("CustomerID",)))
    table = publish_dashboard(spark, processed, BINS, str(tmp_path), "tm_switch")
    panels = dashboard_panels(table)
    kpi = panels["kpi_metrics"].first()
    assert kpi["total_customers"] == processed.count()
    groups = {r["Tenure_category"] for r in panels["churn_by_tenure_group"].collect()}
    assert groups == {"New", "Early-Stage", "Mid-term", "Loyal"}
    assert panels["churn_by_subscription"].count() == 6
    spark.sql("DROP TABLE tm_switch")
