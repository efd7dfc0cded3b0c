"""Statements about models that do not trust the model's own word."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tidemark.functions import hash_bucket
from tidemark.operators import areas, density, importance, models, stump, validation


@pytest.fixture(scope="module")
def rows(spark):
    """Three features: the first decides, the second hints, the third is noise."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((900, 3))
    y = (x[:, 0] + 0.3 * x[:, 1] + 0.2 * rng.standard_normal(900) > 0).astype(float)
    data = [(int(i), float(y[i]), [float(v) for v in x[i]]) for i in range(900)]
    made = spark.createDataFrame(data, "id bigint, label double, values array<double>")
    kept = made.withColumn("features", array_to_vector("values")).repartition(5).cache()
    yield kept
    kept.unpersist()


def test_fold_scores_equal_the_search(spark, rows):
    search = models.cross_validate(rows, "nb", {"smoothing": [1.0]}, "accuracy", folds=4, key="id")
    folded = rows.withColumn("fold", hash_bucket("id", 42, 4))
    got = {r["fold"]: (r["rows"], r["accuracy"]) for r in validation.gaussian_fold_scores(folded, "values", 3, "label", "fold").collect()}
    assert sum(n for n, _ in got.values()) == 900 and set(got) == {0, 1, 2, 3}
    assert np.mean([a for _, a in got.values()]) == pytest.approx(search.avgMetrics[0])
    for fold, (_, accuracy) in got.items():
        model = NaiveBayes(modelType="gaussian").fit(folded.where(F.col("fold") != fold))
        scored = model.transform(folded.where(F.col("fold") == fold))
        assert accuracy == pytest.approx(scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0])


def test_a_fold_with_a_label_of_its_own(spark):
    data = [(0, 0.0, [1.0]), (0, 0.0, [1.2]), (1, 0.0, [0.8]), (1, 0.0, [1.3]), (1, 1.0, [9.0]), (1, 1.0, [9.5])]
    df = spark.createDataFrame(data, "fold int, label double, values array<double>")
    got = {r["fold"]: (r["rows"], r["accuracy"]) for r in validation.gaussian_fold_scores(df, "values", 1, "label", "fold").collect()}
    # Fold 1's model has seen label 0 only.
    assert got == {0: (2, 1.0), 1: (4, 0.5)}


def test_hash_ranks_number_all_rows_whatever_the_partitions(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    one = {r["k"]: r["rank"] for r in importance.hash_ranks(df, "k", ranges=64).collect()}
    two = {r["k"]: r["rank"] for r in importance.hash_ranks(df.repartition(3), "k", ranges=8).collect()}
    assert one == two and sorted(one.values()) == list(range(5000))


@pytest.mark.parametrize("algorithm", ["nb", "lr", "svc"])
def test_permutation_importance_finds_what_decides(spark, rows, algorithm):
    model = models.fit_classifier(rows, algorithm, key="id")
    got = {r["slot"]: r for r in importance.permutation_importance(model, rows, 3, "id").collect()}
    assert got[0]["importance"] > 0.25 and got[0]["importance"] > 3 * got[1]["importance"]
    assert abs(got[2]["importance"]) < 0.03
    # The same by hand: the rows in order of hash, one column moved on.
    order = [r["id"] for r in importance.hash_ranks(rows.select("id"), "id").orderBy("rank").collect()]
    plain = {r["id"]: r for r in rows.collect()}
    moved = []
    for rank, i in enumerate(order):
        values = list(plain[i]["values"])
        values[1] = plain[order[rank - 2]]["values"][1]
        moved.append((plain[i]["label"], values))
    altered = spark.createDataFrame(moved, "label double, values array<double>").select("label", array_to_vector("values").alias("features"))
    hits = model.transform(altered).where("label = prediction").count()
    assert got[1]["accuracy"] == pytest.approx(hits / 900)


def test_best_split_is_the_one_of_a_tree(spark):
    df = spark.range(500).selectExpr(
        "cast((id * 37) % 11 as int) as a", "cast((id * 13) % 7 as double) as b",
        "if(id % 50 = 0, null, cast((id * 5) % 9 as int)) as c",
        "cast((id * 37) % 11 > 6 or (id * 13) % 7 = 3 as int) as y",
    )
    gains = stump.split_gains(df, "y", ["a", "b", "c"])
    best = stump.best_split(gains).first()
    whole = df.dropna()
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(whole)
    tree = DecisionTreeClassifier(maxDepth=1, labelCol="y").fit(vectors)
    root = tree._call_java("rootNode")
    assert best["column"] == ["a", "b", "c"][root.split().featureIndex()]
    assert best["threshold"] == root.split().threshold()
    assert best["gain"] == pytest.approx(root.gain())
    assert gains.count() == 10 + 6 + 8
    assert best["left_rows"] + best["right_rows"] == whole.count()


def test_areas_by_group_equal_the_evaluator(spark):
    df = spark.range(4000).selectExpr(
        "if(id % 3 = 0, 'hot', if(id % 10 = 1, null, concat('g', id % 4))) as g", "id % 2 as h",
        "cast((id * 7919) % 101 < 40 as double) as label",
        "cast((id * 104729) % 997 / 7.0 + if((id * 7919) % 101 < 40, 20, 0) as double) as score",
    )
    got = {(r["g"], r["h"]): r for r in areas.grouped_areas(df, ["g", "h"], score="score", parts=7).collect()}
    keys = [tuple(r) for r in df.select("g", "h").distinct().collect()]
    assert set(got) == set(keys)
    for g, h in keys:
        part = df.where(F.col("g").eqNullSafe(F.lit(g)) & (F.col("h") == h))
        for metric in ("areaUnderROC", "areaUnderPR"):
            want = BinaryClassificationEvaluator(metricName=metric, rawPredictionCol="score", numBins=0).evaluate(part)
            assert got[g, h][metric] == pytest.approx(want)
        assert got[g, h]["rows"] == part.count()


def test_areas_of_everything_ties_gaps_and_single_classes(spark):
    data = [("a", 1.0, 0.5), ("a", 0.0, 0.5), ("b", 1.0, 0.1), ("b", 1.0, 0.7), ("c", None, 0.1), ("c", 0.0, float("nan"))]
    df = spark.createDataFrame(data, "g string, label double, score double")
    got = {r["g"]: (r["rows"], r["areaUnderROC"], r["areaUnderPR"]) for r in areas.grouped_areas(df, ["g"], score="score").collect()}
    assert got == {"a": (2, 0.5, 0.5), "b": (2, None, 1.0)}
    whole = areas.grouped_areas(df, [], score="score").first()
    assert whole["rows"] == 4
    assert areas.grouped_areas(df.limit(0), ["g"], score="score").count() == 0


def test_areas_run_nothing_before_they_are_read(spark):
    df = spark.range(100).selectExpr("id % 2 as g", "cast(id % 3 = 0 as double) as label", "cast(id as double) as score")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy-areas", "no job yet")
    try:
        result = areas.grouped_areas(df, ["g"], score="score")
        assert not tracker.getJobIdsForGroup("lazy-areas")
        assert result.count() == 2
        assert tracker.getJobIdsForGroup("lazy-areas")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_density_is_one_in_all_and_near_the_kernels_sum(spark):
    rng = np.random.default_rng(8)
    data = [(0, float(v), 4.0) for v in rng.standard_normal(400)] + [(1, float(v), 4.0) for v in rng.uniform(2, 9, 300)] + [(1, None, 4.0), (2, 3.0, 4.0)]
    df = spark.createDataFrame(data, "y int, v double, k double")
    got = {}
    for r in density.density_by_label(df, "y", ["v", "k"], points=200).collect():
        got.setdefault((r["y"], r["column"]), []).append((r["point"], r["x"], r["density"]))
    # Neither one value nor a constant has a density.
    assert set(got) == {(0, "v"), (1, "v")}
    for (label, _), points in got.items():
        points.sort()
        x, d = np.array([p[1] for p in points]), np.array([p[2] for p in points])
        assert len(points) == 200 and (d >= 0).all()
        assert np.sum(d) * (x[1] - x[0]) == pytest.approx(1.0, abs=0.02)
        values = np.array([v for y, v, _ in data if y == label and v is not None])
        width = values.std(ddof=1) * len(values) ** -0.2
        exact = np.exp(-0.5 * ((x[:, None] - values) / width) ** 2).sum(axis=1) / (len(values) * width * np.sqrt(2 * np.pi))
        np.testing.assert_allclose(d, exact, atol=0.002)


def test_vectors_stay_vectors(rows):
    assert rows.select(vector_to_array("features").alias("v")).first()["v"] == rows.first()["values"]
