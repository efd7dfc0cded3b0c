"""Run records and champion/challenger promotion, held in plain tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.defaults import PROMOTION_MARGIN

RUNS = "run_id string, model_uid string, kind string, name string, value string"
REGISTRY = "name string, version int, run_id string"


def run_record(
    spark: SparkSession,
    run_id: str,
    model_uid: str,
    params: Mapping[str, str],
    metrics: Mapping[str, float],
    tags: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of one run for the ``runs`` table."""
    kinds = {"param": params, "metric": metrics, "tag": tags or {}}
    rows = [
        (run_id, model_uid, kind, name, None if value is None else str(value))
        for kind, values in kinds.items()
        for name, value in values.items()
    ]
    return spark.createDataFrame(rows, RUNS)


def run_metric(runs: DataFrame, metric: str) -> DataFrame:
    """Rows ``(run_id, model_uid, metric)``, one per run that logged the metric."""
    return (
        runs.where((F.col("kind") == "metric") & (F.col("name") == metric))
        .groupBy("run_id", "model_uid")
        .agg(F.max(F.col("value").cast("double")).alias("metric"))
    )


def latest_versions(registry: DataFrame) -> DataFrame:
    """Newest version of every registered name."""
    newest = Window.partitionBy("name").orderBy(F.desc("version"), "run_id")
    return (
        registry.withColumn("_rank", F.row_number().over(newest))
        .where("_rank = 1")
        .select("name", "version", "run_id")
    )


def promotion_decisions(
    candidates: DataFrame,
    runs: DataFrame,
    registry: DataFrame,
    metric: str = "accuracy",
    margin: float = PROMOTION_MARGIN,
) -> DataFrame:
    """Judge candidate rows ``(name, run_id)`` against the current champion of their name.

    A candidate is promoted when the name has no champion yet, or when its metric
    exceeds the champion's by more than the margin. A metric that is missing on
    either side means no promotion. Each candidate is judged alone; ``promotions`` picks
    the one of each name to append to the registry.
    """
    scores = run_metric(runs, metric).select("run_id", "metric")
    champions = latest_versions(registry).select(
        "name", F.col("version").alias("champion_version"), F.col("run_id").alias("champion_run")
    )
    better = F.col("new_metric") > F.col("old_metric") * (1 + margin)
    first = F.col("champion_version").isNull()
    return (
        candidates.select("name", "run_id")
        .join(champions, "name", "left")
        .join(scores.withColumnRenamed("metric", "new_metric"), "run_id", "left")
        .join(
            scores.select(
                F.col("run_id").alias("champion_run"), F.col("metric").alias("old_metric")
            ),
            "champion_run",
            "left",
        )
        .select(
            "name",
            "run_id",
            "champion_run",
            "new_metric",
            "old_metric",
            F.coalesce(first | better, F.lit(False)).alias("promoted"),
            (F.coalesce(F.col("champion_version"), F.lit(0)) + 1).alias("next_version"),
        )
    )


def promotions(decisions: DataFrame) -> DataFrame:
    """Registry rows to append: of each name the promoted candidate with the best metric.

    Equal metrics go to the smaller run id, a missing one comes last.
    """
    best = Window.partitionBy("name").orderBy(F.desc_nulls_last("new_metric"), "run_id")
    return (
        decisions.where("promoted")
        .withColumn("place", F.row_number().over(best))
        .where("place = 1")
        .select("name", F.col("next_version").cast("int").alias("version"), "run_id")
    )


def champion_model(runs: DataFrame, registry: DataFrame, name: str) -> tuple[int, str] | None:
    """Version and model uid of the current champion of a name, or None."""
    newest = registry.where(F.col("name") == name).orderBy(F.desc("version"), "run_id").limit(1)
    row = (
        newest.join(runs.select("run_id", "model_uid").distinct(), "run_id")
        .select("version", "model_uid")
        .first()
    )
    return None if row is None else (row["version"], row["model_uid"])
