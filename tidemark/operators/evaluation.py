"""Evaluation of scored rows."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import named
from tidemark.operators.logistic import LogisticTable
from tidemark.operators.models import BINARY_METRICS
from tidemark.sources.storage import stored


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", classes=(0, 1)
) -> DataFrame:
    """Rows per label, one count column ``pred_<class>`` for each listed class."""
    return df.groupBy(named(label).alias("label")).agg(
        *[F.count_if(named(prediction) == c).alias(f"pred_{c}") for c in classes]
    )


def label_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Accuracy, weighted precision, weighted recall and weighted F1, as one row.

    Only the counts per (label, prediction) are shuffled.
    """
    cells = df.groupBy(named(label).alias("label"), named(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )
    hit = F.col("label") == F.col("prediction")

    def share(name: Column, labelled: Column, predicted: Column, right: Column) -> Column:
        return F.struct(
            name.alias("class"),
            labelled.alias("labelled"),
            predicted.alias("predicted"),
            right.alias("right"),
        )

    zero, n = F.lit(0).cast("bigint"), F.col("n")
    classes = (
        cells.select(
            F.inline(
                F.array(
                    share(F.col("label"), n, zero, F.when(hit, n).otherwise(zero)),
                    share(F.col("prediction"), zero, n, zero),
                )
            )
        )
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("labelled", "predicted", "right")])
        .withColumns(
            {
                "precision": F.coalesce(F.try_divide("right", "predicted"), F.lit(0.0)),
                "recall": F.coalesce(F.try_divide("right", "labelled"), F.lit(0.0)),
            }
        )
        .withColumn(
            "f1",
            F.coalesce(
                F.try_divide(
                    2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
                ),
                F.lit(0.0),
            ),
        )
    )
    total = F.sum("labelled")

    def weighted(name: str) -> Column:
        return F.try_divide(F.sum(F.col(name) * F.col("labelled")), total)

    return classes.agg(
        F.try_divide(F.sum("right"), total).alias("accuracy"),
        weighted("precision").alias("weightedPrecision"),
        weighted("recall").alias("weightedRecall"),
        weighted("f1").alias("f1"),
    )


def area_metrics(
    df: DataFrame, label: str = "label", score: str = "rawPrediction"
) -> dict[str, float]:
    """Areas under the ROC and precision-recall curves, from every distinct score.

    MLlib sorts the scores across tasks and carries running counts from one to the
    next, so no task sees them all. Each area reads ``df`` once; keep it if it is
    costly.
    """
    rows = df.select(named(label).alias("label"), named(score).alias("score"))
    return {
        metric: BinaryClassificationEvaluator(
            labelCol="label", rawPredictionCol="score", metricName=metric, numBins=0
        ).evaluate(rows)
        for metric in BINARY_METRICS
    }


def area_metrics_frame(
    df: DataFrame, label: str = "label", score: str = "rawPrediction"
) -> DataFrame:
    """``area_metrics`` as a one-row DataFrame."""
    areas = area_metrics(df, label, score)
    return df.sparkSession.createDataFrame(
        [tuple(areas[m] for m in BINARY_METRICS)],
        ", ".join(f"{m} double" for m in BINARY_METRICS),
    )


def evaluate(scored: DataFrame) -> dict[str, float]:
    """All six metrics of rows with ``label``, ``prediction`` and ``rawPrediction``."""
    rows = scored.select("label", "prediction", "rawPrediction").persist()
    try:
        return {**label_metrics(rows).first().asDict(), **area_metrics(rows)}
    finally:
        rows.unpersist()


def evaluate_model(model: Model, test: DataFrame) -> dict[str, float]:
    """Score held-out rows and return the six metrics."""
    return evaluate(model.transform(test))


def log_loss_gradient(
    scored: DataFrame, model: Model | LogisticTable, slots: str = "slots", label: str = "label"
) -> DataFrame:
    """``(slot, gradient)`` of a logistic model's objective at its fitted point; -1 is the intercept.

    The objective is the mean log loss plus the L2 penalty that the model was fitted with, so a model
    at its optimum has 0 everywhere. ``scored`` holds the model's ``probability`` and, as an array
    of ``(slot, value)``, each row's entries other than 0. One aggregate over these entries, of which
    partial sums alone are shuffled; the sums are written once. The penalty must be on plain coefficients
    (``standardization=False``) or absent.
    """
    if isinstance(model, LogisticTable):
        penalty = model.reg_param
        free = F.when(F.col("slot") == -1, 0.0).otherwise(F.col("weight"))
        fitted = model.weights(scored.sparkSession).select("slot", free.alias("weight"))
    else:
        penalty, mixing = model.getRegParam(), model.getElasticNetParam()
        if penalty and (mixing or model.getStandardization()):
            raise ValueError("the gradient is stated for an L2 penalty on plain coefficients")
        # An MLlib model's coefficients are on the driver in any case.
        weights = [(i, float(w)) for i, w in enumerate(model.coefficients.toArray())] + [(-1, 0.0)]
        fitted = scored.sparkSession.createDataFrame(weights, "slot int, weight double")
    residual = vector_to_array("probability")[1] - named(label)
    intercept = F.struct(F.lit(-1).alias("slot"), F.lit(1.0).alias("value"))
    entries = scored.select(residual.alias("residual"), F.explode(F.concat(named(slots), F.array(intercept))).alias("entry"))
    sums = entries.groupBy(F.col("entry.slot").alias("slot")).agg(
        F.sum(F.col("residual") * F.col("entry.value")).alias("sum"), F.count(F.lit(1)).alias("entries")
    )
    sums = stored(sums)
    # Each row has one entry for the intercept; counted there, the rows are not scored again.
    rows = sums.agg(F.max(F.when(F.col("slot") == -1, F.col("entries")))).scalar()
    gradient = F.coalesce(F.col("sum") / rows, F.lit(0.0)) + penalty * F.col("weight")
    return fitted.join(sums, "slot", "left").select("slot", gradient.alias("gradient"))
