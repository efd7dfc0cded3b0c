"""Input tables and the views the queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Features use orders up to this date; the label looks at what comes after.
CUT = "2001-02-01"

CATEGORIES = ["segment", "region"]
MEASURES = [
    "balance",
    "tenure",
    "usage_frequency",
    "payment_delay",
    "total_spend",
    "last_interaction",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customer_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with an order up to the cut: features and 0/1 ``churn``.

    Line items are reduced to one row per order before they meet the orders, and
    one aggregate per customer then yields every order-based column. Both outer
    joins have unique right sides, so Spark leaves out the line items or events
    when a query does not use the column they feed.
    """
    cut = F.lit(CUT).cast("timestamp_ntz")
    lines = (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_shipdate") <= cut)
        .groupBy("l_orderkey")
        .agg(
            F.sum(F.unix_date(F.to_date("l_shipdate"))).alias("ship_days"),
            F.count("l_shipdate").alias("lines"),
        )
    )
    before = F.col("o_orderdate") <= cut
    waited = F.col("ship_days") - F.col("lines") * F.unix_date(F.to_date("o_orderdate"))
    orders = table(spark, sf_dir, "orders")
    behaviour = (
        orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
        .groupBy("o_custkey")
        .agg(
            F.count_if(before).alias("usage_frequency"),
            F.sum(F.when(before, F.col("o_totalprice"))).alias("total_spend"),
            F.min(F.when(before, F.col("o_orderdate"))).alias("first_order"),
            F.max(F.when(before, F.col("o_orderdate"))).alias("last_order"),
            F.sum(F.when(before, waited)).alias("waited"),
            F.sum(F.when(before, F.col("lines"))).alias("shipped"),
            F.max(F.when(F.col("o_orderdate") > cut, 1)).alias("returned"),
        )
        .where("usage_frequency > 0")
    )
    support = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.count_if(F.col("event_type") == "error").alias("support_calls"))
    )
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    today = F.to_date(cut)
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(behaviour, F.col("c_custkey") == F.col("o_custkey"))
        .join(support, F.col("c_custkey") == F.col("user_id"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_acctbal").alias("balance"),
            F.col("c_mktsegment").alias("segment"),
            F.col("r_name").alias("region"),
            F.floor(F.date_diff(today, F.to_date("first_order")) / 30).cast("int").alias("tenure"),
            "usage_frequency",
            "support_calls",
            (F.col("waited").cast("double") / F.col("shipped")).alias("payment_delay"),
            "total_spend",
            F.date_diff(today, F.to_date("last_order")).alias("last_interaction"),
            F.when(F.col("returned").isNull(), 1).otherwise(0).alias("churn"),
        )
    )


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as scored rows: quality is the label, toxic the prediction,
    the length the score."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return (
        table(spark, sf_dir, "labels")
        .join(documents, "doc_id")
        .select(
            "doc_id",
            "lang",
            "source",
            F.col("quality").cast("double").alias("label"),
            F.col("toxic").cast("double").alias("prediction"),
            F.col("n_chars").cast("double").alias("rawPrediction"),
        )
    )


def split_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events of the first and of the second half of the covered time."""
    events = table(spark, sf_dir, "events")
    middle = events.agg(F.expr("min(ts) + (max(ts) - min(ts)) / 2")).scalar()
    late = F.coalesce(F.col("ts") >= middle, F.lit(False))
    return events.where(~late), events.where(late)
