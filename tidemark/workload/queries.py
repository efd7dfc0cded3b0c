"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.defaults import (
    AGE_BINS,
    SEED,
    TENURE_BINS,
    CleanConfig,
    FOLDS,
    FeatureConfig,
    TrainConfig,
)
from tidemark.functions import BinSpec, hash_bucket
from tidemark.operators import (
    areas,
    clean,
    dashboard,
    density,
    derive,
    engagement,
    evaluation,
    features,
    importance,
    logistic,
    models,
    profile,
    quantiles,
    registry,
    sparse,
    split,
    stump,
    validation,
)
from tidemark.plans import Home, score_with_champion, train_and_promote
from tidemark.sinks import publish_table, save, save_counted, save_if_absent
from tidemark.sources.batch import read_catalog_table, read_csv, read_table
from tidemark.sources.files_stream import read_file_stream
from tidemark.sources.rejects import parsed_rows, read_csv_checked, rejected
from tidemark.sources.storage import workspace
from tidemark.streaming.ingest import ingest_available
from tidemark.streaming.upsert import UpsertTable, latest_per_key, upsert
from tidemark.workload.tables import (
    CATEGORIES,
    MEASURES,
    customer_360,
    scored_labels,
    split_events,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FEATURES = FeatureConfig(key="customer_id", label="churn")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, so that sums in another order compare equal."""
    return df.select(
        *[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def staged(df: DataFrame) -> DataFrame:
    """The rows written once and read back, for operators that pass over them again.

    The view reads the two largest tables; one row per customer is cheap to keep.
    """
    path = workspace(df.sparkSession)
    save(df, path)
    return read_table(df.sparkSession, path)


def staged_vectors(df: DataFrame) -> DataFrame:
    """As ``staged``, for rows with a vector, whose type the files' own schema does not tell."""
    path = workspace(df.sparkSession)
    save(df, path)
    return read_table(df.sparkSession, path, schema=df.schema)


# Sources


@query
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    save(table(spark, sf_dir, "customer"), path, fmt="csv", header="true")
    rows = read_csv(spark, path)
    # Inference picks the narrowest type; keys are bigint at every scale.
    return rows.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


def _spoilt_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as lines of text, some with fields of no number, some too short or too long."""
    key = F.col("c_custkey")
    fields = [
        key.cast("string"),
        F.col("c_name"),
        F.when(key % 40 == 11, "none").otherwise(F.col("c_nationkey").cast("string")),
        F.when(key % 10 == 3, "12,5").otherwise(F.col("c_acctbal").cast("string")),
    ]
    quoted_balance = [*fields[:3], F.concat(F.lit('"'), fields[3], F.lit('"'))]
    line = (
        F.when(key % 25 == 7, F.concat_ws(",", *fields[:2]))
        .when(key % 90 == 45, F.concat_ws(",", *quoted_balance, F.lit("more")))
        .otherwise(F.concat_ws(",", *quoted_balance))
    )
    path = workspace(spark)
    table(spark, sf_dir, "customer").select(line.alias("value")).write.text(path)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double"
    return read_csv_checked(spark, path, schema, header=False)


@query
def scan_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected(_spoilt_customers(spark, sf_dir), ["c_custkey"])


@query
def scan_csv_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_rows(_spoilt_customers(spark, sf_dir))


@query
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, f"{sf_dir}/events.parquet")
    return events.select("event_id", "user_id", "event_type", "value")


# Sinks


@query
def write_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    rows = customer_360(spark, sf_dir).select("customer_id", "segment", "region", "churn")
    save(rows, path, partitions=CATEGORIES)
    return (
        read_table(spark, path)
        .groupBy("segment", "region")
        .agg(F.count(F.lit(1)).alias("customers"), F.sum("churn").alias("churned"))
    )


@query
def write_repartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    save(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), path, repartition=5)
    rows = read_table(spark, path).select("o_orderkey", F.input_file_name().alias("file"))
    return rows.agg(F.countDistinct("file").alias("files"), F.count(F.lit(1)).alias("rows_written"))


@query
def write_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    save(table(spark, sf_dir, "nation"), path)
    save(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), path)
    return read_table(spark, path)


@query
def write_with_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = save_counted(
        table(spark, sf_dir, "orders"), workspace(spark), partitions=["o_orderstatus"]
    )
    return spark.createDataFrame([(written,)], "rows_written bigint")


@query
def write_with_count_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = save_counted(table(spark, sf_dir, "customer"), workspace(spark), fmt="json")
    return spark.createDataFrame([(written,)], "rows_written bigint")


@query
def write_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    save_if_absent(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), path)
    save_if_absent(table(spark, sf_dir, "nation"), path)
    return read_table(spark, path)


def publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = customer_360(spark, sf_dir).select("customer_id", "segment", "tenure", "churn")
    publish_table(rows, "tidemark_customer_churn", workspace(spark))
    return read_catalog_table(spark, "tidemark_customer_churn")


QUERIES["publish_table"] = publish


# Streaming and upsert

EVENT_COLUMNS = ["user_id", "event_id", "event_type", "value"]


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = workspace(spark)
    ingested = UpsertTable(f"{home}/table", key=("user_id",), order_by=("ts", "event_id"))
    for drop in split_events(spark, sf_dir):
        drop.write.mode("append").parquet(f"{home}/arrivals")
        arriving = read_file_stream(spark, f"{home}/arrivals", schema_path=f"{home}/schema")
        ingest_available(arriving, ingested, f"{home}/checkpoint")
    return ingested.read(spark).select(*EVENT_COLUMNS)


@query
def stream_two_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each half of the events through a stream of its own, into one table."""
    home = workspace(spark)
    ingested = UpsertTable(f"{home}/table", key=("user_id",), order_by=("ts", "event_id"))
    for number, drop in enumerate(split_events(spark, sf_dir)):
        drop.write.parquet(f"{home}/arrivals{number}")
        arriving = read_file_stream(
            spark, f"{home}/arrivals{number}", schema_path=f"{home}/schema{number}"
        )
        ingest_available(arriving, ingested, f"{home}/checkpoint{number}")
    return ingested.read(spark).select(*EVENT_COLUMNS)


@query
def stream_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second drop brings a column that the first lacks."""
    home = workspace(spark)
    ingested = UpsertTable(f"{home}/table", key=("user_id",), order_by=("ts", "event_id"))
    first, second = split_events(spark, sf_dir)
    for drop in (first.drop("value"), second):
        drop.write.mode("append").parquet(f"{home}/arrivals")
        arriving = read_file_stream(spark, f"{home}/arrivals", schema_path=f"{home}/schema")
        ingest_available(arriving, ingested, f"{home}/checkpoint")
    return ingested.read(spark).select(*EVENT_COLUMNS)


@query
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = split_events(spark, sf_dir)
    order = ["ts", "event_id"]
    target = latest_per_key(first, ["user_id"], order)
    return upsert(target, second, ["user_id"], order).select(*EVENT_COLUMNS)


@query
def upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Halves of the events as batches, the first one folded into a copy; read bucket by bucket."""
    held = UpsertTable(workspace(spark), key=("user_id",), order_by=("ts", "event_id"))
    for number, batch in enumerate(split_events(spark, sf_dir)):
        held.apply(batch, number)
        if number == 0:
            held.compact(spark)
    return held.read(spark).select(*EVENT_COLUMNS)


# Cleaning and projections


@query
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_columns(table(spark, sf_dir, "customer"), ["c_custkey", "no_such_column"])


@query
def normalise_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    spaced = customer_360(spark, sf_dir).select(
        F.col("customer_id").alias("Customer ID"),
        F.col("total_spend").alias("Total Spend"),
        F.col("segment").alias("Subscription Type"),
    )
    return rounded(clean.normalise_names(spaced))


@query
def project_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.project_label(customer_360(spark, sf_dir), ["customer_id", "tenure"], "churn")


@query
def column_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_roles(customer_360(spark, sf_dir), "churn", ["customer_id"])


@query
def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.schema_report(table(spark, sf_dir, "lineitem"))


@query
def dropna_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["support_calls", "total_spend", "payment_delay"]
    kept = clean.drop_missing_rows(customer_360(spark, sf_dir), columns)
    return rounded(kept.select("customer_id", *columns))


@query
def filter_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean.missing_rows(customer_360(spark, sf_dir), "support_calls")
    return rows.select("customer_id", "segment", "churn")


@query
def dedup_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return clean.deduplicate(orders.select("o_custkey", "o_orderstatus", "o_orderpriority"))


LINE_COLUMNS = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


@query
def dedup_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("l_discount", F.col("l_discount") + 0.0)
    return clean.deduplicate(
        lines.select(*LINE_COLUMNS), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"]
    )


@query
def head_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = customer_360(spark, sf_dir).select("customer_id", "segment", "tenure", "churn")
    return clean.head(customers, ["customer_id"], 20)


@query
def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = CleanConfig(drop=("customer_id",), dropna=("support_calls",))
    rows = customer_360(spark, sf_dir).select(
        "customer_id", "segment", "region", "support_calls", "churn"
    )
    return clean.clean(rows, config)


# Profiling


@query
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.row_count(table(spark, sf_dir, "lineitem"))


@query
def describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.describe(customer_360(spark, sf_dir)))


@query
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.null_profile(customer_360(spark, sf_dir)))


@query
def rate_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.rate_by_category(customer_360(spark, sf_dir), "churn", CATEGORIES))


@query
def corr_with_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [*MEASURES, "support_calls"]
    return rounded(profile.corr_with_label(customer_360(spark, sf_dir), "churn", columns))


@query
def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.corr_matrix(customer_360(spark, sf_dir), [*MEASURES, "churn"]))


@query
def box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Read once for each pass.
    customers = staged(customer_360(spark, sf_dir).select("churn", *MEASURES))
    return rounded(quantiles.box_stats(customers, "churn", MEASURES))


@query
def density_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["tenure", "balance", "last_interaction"]
    customers = staged(customer_360(spark, sf_dir).select("churn", *columns))
    found = density.density_by_label(customers, "churn", columns)
    return found.select("churn", "column", "point", F.round("x", 6).alias("x"), F.round("density", 12).alias("density"))


@query
def hist_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["tenure", "usage_frequency", "balance", "last_interaction"]
    customers = staged(customer_360(spark, sf_dir).select("churn", *columns))
    return profile.hist_by_label(customers, "churn", columns, bins=10)


# Dashboard


@query
def kpi_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.kpi_metrics(customer_360(spark, sf_dir), "churn", "tenure", "total_spend")


@query
def churn_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.label_counts(customer_360(spark, sf_dir), "churn")


@query
def churn_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.label_counts(customer_360(spark, sf_dir), "churn", "segment")


@query
def churn_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.label_counts(customer_360(spark, sf_dir), "churn", "region")


@query
def churn_by_tenure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.label_counts(customer_360(spark, sf_dir), "churn", "tenure")


@query
def churn_by_support_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = customer_360(spark, sf_dir)
    return dashboard.label_counts(customers, "churn", "support_calls", ordered=True)


@query
def churn_by_tenure_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = derive.bin_columns(customer_360(spark, sf_dir), [BinSpec("tenure", TENURE_BINS)])
    return dashboard.label_counts(grouped, "churn", "tenure_category")


@query
def churn_by_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.label_counts(customer_360(spark, sf_dir), "churn", "usage_frequency")


@query
def avg_by_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = {
        "avg_balance": "balance",
        "avg_tenure": "tenure",
        "avg_usage": "usage_frequency",
        "avg_support_calls": "support_calls",
        "avg_payment_delay": "payment_delay",
        "avg_spend": "total_spend",
    }
    return rounded(dashboard.averages_by_label(customer_360(spark, sf_dir), "churn", measures))


@query
def churn_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [*CATEGORIES, "tenure", "support_calls", "usage_frequency"]
    return dashboard.label_counts_all(customer_360(spark, sf_dir), "churn", keys)


# Derived columns


@query
def bin_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = customer_360(spark, sf_dir).select(
        "customer_id", "tenure", F.col("tenure").alias("age")
    )
    return derive.bin_columns(
        customers, [BinSpec("age", AGE_BINS), BinSpec("tenure", TENURE_BINS)]
    )


@query
def bin_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = customer_360(spark, sf_dir).select("customer_id", F.col("tenure").alias("age"))
    return derive.bin_age(customers)


@query
def bin_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("balance")
    )
    return derive.bin_balance(orders)


@query
def bin_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = customer_360(spark, sf_dir).select("customer_id", "last_interaction")
    return derive.bin_score(customers, "last_interaction")


@query
def bin_tenure(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = customer_360(spark, sf_dir).select("customer_id", "usage_frequency")
    return derive.bin_tenure(customers, "usage_frequency")


@query
def ratio_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = customer_360(spark, sf_dir).select("customer_id", "total_spend", "support_calls")
    return rounded(derive.ratio_column(customers, "total_spend", "support_calls"))


def _engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment")
    )
    return engagement.engagement_inputs(
        table(spark, sf_dir, "events"), segments, "user_id", "ts", "event_type", "segment"
    )


@query
def engagement_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_engagement(spark, sf_dir))


@query
def engagement_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = derive.engagement_score(_engagement(spark, sf_dir))
    return rounded(scored.select("segment", "engagement_score"))


# Sampling and splits


@query
def sample_bernoulli(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return split.sample(orders, 0.01, SEED)


@query
def sample_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is certain of a random sample: rows of the table, each once, and about as many as asked for.

    Their number is within six deviations of its mean but for two samples in a thousand million.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    drawn = split.sample(orders, 0.01, SEED).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("times"))
    both = orders.join(drawn, "o_orderkey", "left")
    rows, taken = F.count(F.lit(1)), F.sum(F.coalesce("times", F.lit(0)))
    strays = drawn.join(orders, "o_orderkey", "left_anti").agg(F.count(F.lit(1))).scalar()
    return both.agg(
        rows.alias("rows"),
        ((F.max(F.coalesce("times", F.lit(0))) <= 1) & (strays == 0)).alias("known"),
        (F.abs(taken - rows * 0.01) <= 6 * F.sqrt(rows * 0.01 * 0.99)).alias("near"),
    )


@query
def sample_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return split.sample_by_hash(orders, "o_orderkey", 0.01)


@query
def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = customer_360(spark, sf_dir).select("customer_id", "churn")
    return split.tag_split(customers, "customer_id")


@query
def split_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    train, test = split.split_random(customers)
    # Each customer is in one part: the parts together are the input.
    both = train.unionByName(test)
    return both.groupBy("c_custkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("parts"))


# Features


@query
def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged(customer_360(spark, sf_dir).select("customer_id", *CATEGORIES))
    indexed = features.string_index(rows, CATEGORIES)
    return indexed.select("customer_id", *[f"{c}_idx" for c in CATEGORIES])


@query
def string_index_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rows = staged(orders.select("o_orderkey", F.col("o_orderkey").cast("string").alias("text")))
    return features.string_index(rows, ["text"]).select("o_orderkey", "text_idx")


@query
def one_hot_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rows = staged(
        orders.select(
            "o_orderkey", "o_orderstatus", F.col("o_custkey").cast("string").alias("customer")
        )
    )
    return features.one_hot_slots(rows, ["o_orderstatus", "customer"], ["o_orderkey"])


@query
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged(customer_360(spark, sf_dir).select("customer_id", "segment"))
    encoded = features.one_hot(rows, ["segment"])
    return features.vector_slots(encoded, "segment_vec", ["customer_id"])


@query
def assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["customer_id", "segment", "support_calls", "tenure"]
    rows = staged(customer_360(spark, sf_dir).select(*columns))
    encoded = features.one_hot(rows, ["segment"])
    assembled = features.assemble(encoded, ["segment_vec"], ["support_calls", "tenure"])
    return features.vector_slots(assembled, features.RAW, ["customer_id"])


@query
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["tenure", "balance", "last_interaction"]
    rows = staged(customer_360(spark, sf_dir).select("customer_id", *columns))
    scaled = features.standard_scale(rows, columns)
    return rounded(features.vector_slots(scaled, features.FEATURES, ["customer_id"]))


def _prepared(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Prepared training and test rows, read back from a table written once."""
    path = workspace(spark)
    prepared = features.prepare(customer_360(spark, sf_dir), FEATURES)
    save(split.tag_split(prepared, FEATURES.key), path, partitions=["part"])
    rows = read_table(spark, path)
    return (
        rows.where("part = 'train'").drop("part"),
        rows.where("part = 'test'").drop("part"),
    )


# The prepared table holds the label under its new name.
PREPARED = FeatureConfig(key="customer_id", label="label")


@query
def ml_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _prepared(spark, sf_dir)
    fitted = features.fit_features(train, PREPARED)
    scaled = fitted.transform(train.unionByName(test))
    return rounded(features.vector_slots(scaled, features.FEATURES, ["customer_id", "label"]))


WIDE = FeatureConfig(key="line", label="label", wide=True)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items, labelled returned or not, with their order as a category of very many values."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line"),
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        F.col("l_orderkey").cast("string").alias("order"),
        F.col("l_linestatus").alias("status"),
        F.col("l_quantity").cast("double").alias("quantity"),
        F.col("l_extendedprice").cast("double").alias("price"),
    )


@query
def sparse_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots other than 0 of all lines, by features fitted on the training part."""
    lines = split.tag_split(_lines(spark, sf_dir), "line")
    path = workspace(spark)
    sparse.fit_sparse(lines.where("part = 'train'").drop("part"), WIDE, path)
    found = sparse.load_sparse(spark, path).slots(lines)
    return rounded(found.select("line", F.inline("slots")))


@query
def sparse_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log loss gradient in every slot of a wide model, saved and loaded with its index.

    The training part is scored again through the saved index; at the optimum all is 0.
    """
    home, uid = workspace(spark), sparse.new_wide_uid()
    saved = sparse.features_path(home, uid)
    train, _ = split.split_by_hash(_lines(spark, sf_dir), "line")
    logistic.fit_logistic(train, sparse.fit_sparse(train, WIDE, saved), f"{home}/{uid}/logistic", reg_param=0.01)
    model = logistic.load_logistic(spark, sparse.load_sparse(spark, saved), f"{home}/{uid}/logistic")
    gradient = evaluation.log_loss_gradient(model.transform(train), model)
    # Rounding may leave a negative 0.
    return gradient.select("slot", (F.round("gradient", 4) + 0.0).alias("gradient"))


# Models


def _train(spark: SparkSession, sf_dir: str, algorithm: str):
    train, test = _prepared(spark, sf_dir)
    fitted = features.fit_features(train, PREPARED)
    model = models.fit_classifier(fitted.transform(train), algorithm, key="customer_id")
    return fitted, model, train, test


def _predict_with(algorithm: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fitted, model, _, test = _train(spark, sf_dir, algorithm)
        scored = models.predict(model, fitted.transform(test))
        return scored.select("customer_id", "label", "prediction")

    return run


for _algorithm in models.ALGORITHMS:
    QUERIES[f"predict_{_algorithm}"] = _predict_with(_algorithm)


@query
def lr_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log loss gradient of the fitted logistic model over its training rows: 0 in every slot."""
    fitted, model, train, _ = _train(spark, sf_dir, "lr")
    entries = F.transform(vector_to_array("features"), lambda x, i: F.struct(i.alias("slot"), x.alias("value")))
    scored = models.predict(model, fitted.transform(train)).withColumn("slots", entries)
    gradient = evaluation.log_loss_gradient(scored, model)
    return gradient.select("slot", (F.round("gradient", 3) + 0.0).alias("gradient"))


COUNTED = ["tenure", "usage_frequency", "support_calls"]


@query
def dtc_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gain of every split that a tree of depth 1 chooses from."""
    return rounded(stump.split_gains(customer_360(spark, sf_dir), "churn", COUNTED))


@query
def dtc_best_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    gains = stump.split_gains(customer_360(spark, sf_dir), "churn", COUNTED)
    return rounded(stump.best_split(gains))


@query
def permutation_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy on the test part that naive Bayes loses without each feature slot."""
    fitted, model, _, test = _train(spark, sf_dir, "nb")
    rows = staged_vectors(fitted.transform(test).select("customer_id", "label", "features"))
    return rounded(importance.permutation_importance(model, rows, model.numFeatures, "customer_id"))


@query
def batch_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = workspace(spark)
    fitted, model, train, test = _train(spark, sf_dir, "nb")
    stages = [models.save_model(m, home) for m in (fitted, model)]
    scored = train.unionByName(test)
    for uid in stages:
        scored = models.predict(models.load_model(spark, home, uid), scored)
    return scored.select("customer_id", "label", "prediction")


def _trained_home(spark: SparkSession, sf_dir: str, runs: int) -> Home:
    home = Home(workspace(spark))
    customers = customer_360(spark, sf_dir)
    for _ in range(runs):
        train_and_promote(
            spark, customers, home, "churn", CleanConfig(), FEATURES, TrainConfig("nb")
        )
    return home


@query
def train_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry after two equal runs of the training flow: the second is no improvement."""
    home = _trained_home(spark, sf_dir, 2)
    versions = home.table(spark, home.registry, registry.REGISTRY)
    logged = home.table(spark, home.runs, registry.RUNS).select("run_id").distinct()
    return versions.join(logged, "run_id").select("name", "version")


@query
def train_promote_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered version with the accuracy that its run recorded on the test part."""
    home = _trained_home(spark, sf_dir, 1)
    runs = home.table(spark, home.runs, registry.RUNS)
    scores = registry.run_metric(runs, "accuracy").select("run_id", F.col("metric").alias("accuracy"))
    versions = home.table(spark, home.registry, registry.REGISTRY)
    return rounded(versions.join(scores, "run_id").select("name", "version", "accuracy"))


@query
def model_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a saved and loaded model says of itself: some of its parameters, and its size."""
    home = workspace(spark)
    _, fitted, _, _ = _train(spark, sf_dir, "nb")
    model = models.load_model(spark, home, models.save_model(fitted, home))
    told = models.param_map(model)
    rows = [(n, told[n]) for n in ("featuresCol", "labelCol", "modelType", "predictionCol", "smoothing")]
    rows += [("numClasses", str(model.numClasses)), ("numFeatures", str(model.numFeatures))]
    return spark.createDataFrame(rows, "name string, value string")


@query
def score_champion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers, without their label, scored by the inference flow."""
    home = _trained_home(spark, sf_dir, 1)
    unlabelled = customer_360(spark, sf_dir).drop("churn")
    return score_with_champion(spark, unlabelled, home, "churn", CleanConfig(), FEATURES)


@query
def cv_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _prepared(spark, sf_dir)
    rows = features.fit_features(train, PREPARED).transform(train)
    rows = models.spread(rows.select("customer_id", "features", "label")).persist()
    try:
        grid = {"maxDepth": [2, 4], "impurity": ["gini", "entropy"]}
        search = models.cross_validate(rows, "dtc", grid, "accuracy", key="customer_id")
    finally:
        rows.unpersist()
    return models.cv_scores(spark, search, "accuracy")


@query
def search_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a grid search whose folds follow the key's hash."""
    train, _ = _prepared(spark, sf_dir)
    rows = features.fit_features(train, PREPARED).transform(train)
    rows = staged_vectors(rows.select("customer_id", "features", "label"))
    search = models.cross_validate(rows, "nb", {"smoothing": [0.5, 1.0, 2.0]}, "accuracy", key="customer_id")
    return rounded(models.cv_scores(spark, search, "accuracy"))


@query
def cv_scores_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of naive Bayes in each fold, all folds fitted from one aggregate."""
    train, _ = _prepared(spark, sf_dir)
    rows = features.fit_features(train, PREPARED).transform(train)
    width = len(models.feature_names(rows))
    folded = rows.select(
        "label", vector_to_array("features").alias("values"), hash_bucket("customer_id", SEED, FOLDS).alias("fold")
    )
    return rounded(validation.gaussian_fold_scores(folded, "values", width, "label", "fold"))


@query
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, model, train, _ = _train(spark, sf_dir, "rfc")
    return models.feature_importance(fitted, model, train)


# Evaluation


@query
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion_matrix(scored_labels(spark, sf_dir))


@query
def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluation.label_metrics(scored_labels(spark, sf_dir)))


@query
def eval_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = staged(scored_labels(spark, sf_dir).select("label", "rawPrediction"))
    return rounded(evaluation.area_metrics_frame(scored))


@query
def eval_auc_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas for the documents of each language and source."""
    return rounded(areas.grouped_areas(scored_labels(spark, sf_dir), ["lang", "source"]))


# Registry


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document source of a language as one run, with its accuracy and size."""
    scores = (
        scored_labels(spark, sf_dir)
        .groupBy("lang", "source")
        .agg(
            F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
            F.count(F.lit(1)).cast("double").alias("rows"),
        )
    )
    rows = scores.unpivot(["lang", "source"], ["accuracy", "rows"], "name", "value").select(
        F.concat_ws("/", "lang", "source").alias("run_id"),
        F.col("source").alias("model_uid"),
        F.lit("metric").alias("kind"),
        "name",
        F.col("value").cast("string").alias("value"),
    )
    return staged(rows)


def _registry(runs: DataFrame) -> DataFrame:
    """All runs, registered per language in order of their id."""
    named_runs = registry.run_metric(runs, "rows").select(F.split("run_id", "/")[0].alias("name"), "run_id")
    version = F.row_number().over(Window.partitionBy("name").orderBy("run_id"))
    return named_runs.select("name", version.alias("version"), "run_id")


@query
def promote_champion(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _runs(spark, sf_dir)
    candidates = registry.run_metric(runs, "accuracy").select(
        F.split("run_id", "/")[0].alias("name"), "run_id"
    )
    return rounded(registry.promotion_decisions(candidates, runs, _registry(runs)))


@query
def promote_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry after promotion: five runs of each name are known, the others are candidates."""
    runs = _runs(spark, sf_dir)
    known = _registry(runs).where("version <= 5")
    candidates = registry.run_metric(runs, "accuracy").select(
        F.split("run_id", "/")[0].alias("name"), "run_id"
    )
    candidates = candidates.join(known.select("run_id"), "run_id", "left_anti")
    decisions = registry.promotion_decisions(candidates, runs, known)
    return known.unionByName(registry.promotions(decisions))


@query
def latest_champion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.latest_versions(_registry(_runs(spark, sf_dir)))
