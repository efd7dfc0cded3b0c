import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidemark.defaults import GRIDS, FeatureConfig
from tidemark.operators import evaluation, features, models

CONFIG = FeatureConfig(key="id", label="y")


@pytest.fixture(scope="module")
def customers(spark):
    return spark.range(200).selectExpr(
        "id",
        "cast(id % 7 > 3 as int) as y",
        "concat('g', id % 3) as g",
        "if(id % 11 = 0, null, cast(id % 7 as int)) as x",
        "cast(id as double) as z",
    )


@pytest.fixture(scope="module")
def prepared(customers):
    return features.prepare(customers, CONFIG).cache()


@pytest.fixture(scope="module")
def fitted(prepared):
    return features.fit_features(prepared, FeatureConfig(key="id", label="label"))


def test_unseen_and_null_categories_are_all_zeros(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0)], "g string, x double")
    model = features.Pipeline(stages=features.feature_stages(["g"], ["x"])).fit(train)
    new = spark.createDataFrame([("zzz", 1.0), (None, None), ("b", 2.0)], "g string, x double")
    got = [r["g_vec"].toArray().tolist() for r in model.transform(new).collect()]
    assert got == [[0, 0], [0, 0], [0, 1]]
    filled = [r["x_filled"] for r in model.transform(new).collect()]
    assert filled == [1.0, 2.0, 2.0]


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "k double, x double")
    got = [r["features"].toArray().tolist() for r in features.standard_scale(df, ["k", "x"]).collect()]
    assert [v[0] for v in got] == [0.0, 0.0]
    assert abs(got[0][1]) == pytest.approx(0.70710678)


def test_null_handling_choices(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None)], "id int, x double")
    dropped = features.prepare(df, FeatureConfig(key="id", label=None, nulls="drop"))
    assert dropped.count() == 1
    assert features.prepare(df, FeatureConfig(key="id", label=None, nulls="keep")).count() == 2
    with pytest.raises(ValueError):
        features.feature_stages([], ["x"], "other")


def test_boolean_columns_are_numbers(spark):
    df = spark.createDataFrame([(1, True, "a")], "id int, b boolean, s string")
    assert features.feature_columns(df, FeatureConfig(key="id", label=None)) == (["s"], ["b"])
    assert features.prepare(df, FeatureConfig(key="id", label=None)).first()["b"] == 1.0


def test_any_number_of_categories(spark):
    df = spark.range(20_000).selectExpr("concat('v', id) as g", "id % 7 as k", "1 as _value", "2 as _idx")
    got = features.string_index(df, ["g"])
    assert got.columns == ["g", "k", "_value", "_idx", "g_idx"]
    assert sorted(r[0] for r in got.select("g_idx").collect()) == list(range(20_000))
    slots = features.one_hot_slots(df.selectExpr("cast(k as string) k", "g"), ["k", "g"], ["g"])
    assert slots.where("column = 'g'").agg({"slot": "max"}).first()[0] == 20_006


def test_string_index_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "g string")
    got = {r["g"]: r["g_idx"] for r in features.string_index(df, ["g"]).collect()}
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0, None: 3.0}


def test_grid_sizes():
    sizes = {}
    for name, values in GRIDS.items():
        estimator, known = models.classifier(name)
        assert known
        sizes[name] = len(models.param_grid(estimator, values))
    assert sizes == {"rfc": 54, "gbt": 9}


def test_unknown_algorithm_becomes_untuned_gbt():
    estimator, known = models.classifier("nope")
    assert type(estimator).__name__ == "GBTClassifier" and not known


def test_evaluator_choice():
    assert isinstance(models.evaluator_for("areaUnderPR"), BinaryClassificationEvaluator)
    assert isinstance(models.evaluator_for("f1"), MulticlassClassificationEvaluator)


@pytest.mark.parametrize("algorithm", sorted(models.ALGORITHMS))
def test_train_save_load_predict(spark, tmp_path, prepared, fitted, algorithm, monkeypatch):
    monkeypatch.setitem(models.ALGORITHMS, "svc", lambda: LinearSVC(maxIter=5))
    monkeypatch.setitem(models.ALGORITHMS, "gbt", lambda: GBTClassifier(maxIter=3))
    rows = fitted.transform(prepared)
    model = models.fit_classifier(rows, algorithm, key="id")
    uid = models.save_model(model, str(tmp_path))
    loaded = models.load_model(spark, str(tmp_path), uid)
    assert type(loaded) is type(model)
    want = {r["id"]: r["prediction"] for r in models.predict(model, rows).select("id", "prediction").collect()}
    got = {r["id"]: r["prediction"] for r in models.predict(loaded, rows).select("id", "prediction").collect()}
    assert got == want and len(got) == 200
    assert "featuresCol" in models.param_map(loaded)


def test_unknown_model_raises(spark, tmp_path):
    with pytest.raises(Exception):
        models.load_model(spark, str(tmp_path), "GBTClassifier_unknown")


def test_search_is_repeatable_and_picks_the_best(spark, prepared, fitted):
    rows = fitted.transform(prepared).select("id", "features", "label").cache()
    grid = {"maxDepth": [1, 4]}
    first = models.cross_validate(rows, "dtc", grid, key="id")
    second = models.cross_validate(rows.repartition(5), "dtc", grid, key="id")
    assert first.avgMetrics == pytest.approx(second.avgMetrics)
    # Without a key Spark draws the folds.
    drawn = models.cross_validate(rows, "dtc", grid)
    assert len(drawn.avgMetrics) == 2
    scores = {r["params"]: r["score"] for r in models.cv_scores(spark, first, "accuracy").collect()}
    assert set(scores) == {"maxDepth=1", "maxDepth=4"}
    best = models.fit_classifier(rows, "dtc", grid, key="id")
    assert best.getMaxDepth() == (4 if scores["maxDepth=4"] > scores["maxDepth=1"] else 1)


def test_importance_names_every_slot(prepared, fitted):
    model = models.fit_classifier(fitted.transform(prepared), "rfc", key="id")
    got = {r["feature"]: r["importance"] for r in models.feature_importance(fitted, model, prepared).collect()}
    assert set(got) == {"g_vec_g0", "g_vec_g1", "g_vec_g2", "x_filled", "z_filled"}
    assert sum(got.values()) == pytest.approx(1.0)
    assert max(got, key=got.get) == "x_filled"


def test_metrics_equal_mllib(spark):
    scored = spark.range(500).select(
        ((F.col("id") * 7) % 3 % 2).cast("double").alias("label"),
        ((F.col("id") * 11) % 5 % 2).cast("double").alias("prediction"),
        ((F.col("id") * 13) % 50).cast("double").alias("rawPrediction"),
    )
    got = evaluation.evaluate(scored)
    for metric in ("accuracy", "weightedPrecision", "weightedRecall", "f1"):
        assert got[metric] == pytest.approx(
            MulticlassClassificationEvaluator(metricName=metric).evaluate(scored)
        )
    for metric in ("areaUnderROC", "areaUnderPR"):
        assert got[metric] == pytest.approx(
            BinaryClassificationEvaluator(metricName=metric, numBins=0).evaluate(scored)
        )


def test_metrics_with_a_class_never_predicted(spark):
    scored = spark.createDataFrame(
        [(0.0, 0.0), (1.0, 0.0), (2.0, 0.0)], "label double, prediction double"
    )
    got = evaluation.label_metrics(scored).first()
    for metric in ("accuracy", "weightedPrecision", "weightedRecall", "f1"):
        assert got[metric] == pytest.approx(
            MulticlassClassificationEvaluator(metricName=metric).evaluate(scored)
        )


def test_confusion_matrix_has_zero_cells(spark):
    scored = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, prediction int")
    got = {r["label"]: (r["pred_0"], r["pred_1"]) for r in evaluation.confusion_matrix(scored).collect()}
    assert got == {0: (2, 0), 1: (1, 0)}


def test_whole_model_round_trip(spark, tmp_path, prepared, fitted):
    model = models.fit_classifier(fitted.transform(prepared), "dtc", key="id")
    whole = PipelineModel(stages=[*fitted.stages, model])
    loaded = models.load_model(spark, str(tmp_path), models.save_model(whole, str(tmp_path)))
    assert isinstance(loaded, PipelineModel)
    assert evaluation.evaluate_model(loaded, prepared) == pytest.approx(
        evaluation.evaluate_model(whole, prepared)
    )


def test_rows_of_one_file_are_spread_over_the_tasks_of_a_fit(spark, monkeypatch):
    rows = spark.range(4000).coalesce(1).selectExpr("id", "cast(id % 2 as double) as label", "array(cast(id % 7 as double), 1.0D) as v")
    rows = rows.select("id", "label", array_to_vector("v").alias("features"))
    assert models.spread(rows) is rows
    parts = models.spread(rows, 1000).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 8 and sum(r["count"] for r in parts) == 4000 and max(r["count"] for r in parts) < 510
    assert models.spread(rows.limit(0)).count() == 0
    # The fit itself reads its rows so dealt.
    read = []
    monkeypatch.setattr(models, "spread", lambda r, f=models.spread: read.append(f(r, 1000)) or read[0])
    models.fit_classifier(rows, "dtc", key="id")
    assert read[0].rdd.getNumPartitions() == 8
