"""Features for wide categories, and the models on them."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from tidemark.defaults import CleanConfig, FeatureConfig, TrainConfig
from tidemark.operators import evaluation, features, logistic, sparse
from tidemark.plans import Home, score_with_champion, train_and_promote

CONFIG = FeatureConfig(key="id", label="label", wide=True)
SCHEMA = "id bigint, label double, g string, `a b` string, x double, k double"
ROWS = [
    (1, 0.0, "p", "2024", 1.0, 5.0),
    (2, 1.0, "p", "2024", 2.0, 5.0),
    (3, 0.0, "q", "7", None, 5.0),
    (4, 1.0, None, "7", 6.0, 5.0),
    (5, 1.0, "q", "1e3", float("nan"), 5.0),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def slots_of(df):
    return {r["id"]: [(s["slot"], s["value"]) for s in r["slots"]] for r in df.collect()}


def test_slots_are_numbered_by_frequency_and_only_numbers_are_scaled(spark, rows, tmp_path):
    fitted = sparse.fit_sparse(rows, CONFIG, str(tmp_path))
    # g: p, q; a b: 2024, 7 (two each, by name), 1e3; then x and the constant k.
    assert fitted.width == 7
    deviation = np.std([1.0, 2.0, 3.0, 6.0, 3.0], ddof=1)
    got = slots_of(fitted.slots(rows))
    assert got[1] == [(0, 1.0), (2, 1.0), (5, pytest.approx(-2 / deviation))]
    assert got[3] == [(1, 1.0), (3, 1.0)] and got[5] == [(1, 1.0), (4, 1.0)]
    assert got[4] == [(3, 1.0), (5, pytest.approx(3 / deviation))]


def test_a_loaded_index_is_the_fitted_one(spark, rows, tmp_path):
    fitted = sparse.fit_sparse(rows, CONFIG, str(tmp_path))
    loaded = sparse.load_sparse(spark, str(tmp_path))
    assert loaded == fitted
    new = spark.createDataFrame([(9, "unseen", "2024", 3.0, 1.0), (10, "q", None, None, 1.0)], "id bigint, g string, `a b` string, x double, k double")
    got = slots_of(loaded.slots(new))
    assert got == {9: [(2, 1.0)], 10: [(1, 1.0)]}


def test_kept_gaps_are_nan_and_dropped_ones_do_not_count(spark, rows, tmp_path):
    keep = sparse.fit_sparse(rows, FeatureConfig(key="id", label="label", nulls="keep"), str(tmp_path / "k"))
    value = dict(slots_of(keep.slots(rows))[3])[5]
    assert np.isnan(value)
    deviation = np.std([1.0, 2.0, 6.0], ddof=1)
    assert keep.columns[2].deviation == pytest.approx(deviation)
    with pytest.raises(ValueError):
        sparse.fit_sparse(rows, FeatureConfig(key="id", label="label", nulls="other"), str(tmp_path / "o"))


def test_vectors_are_sparse_and_have_no_names(spark, tmp_path):
    wide = spark.range(20_000).selectExpr("id", "cast(id % 2 as double) as label", "concat('v', id) as g", "cast(id % 9 as double) as x")
    fitted = sparse.fit_sparse(wide, CONFIG, str(tmp_path))
    vectors = fitted.vectors(wide)
    assert fitted.width == 20_001 and vectors.schema["features"].metadata == {}
    found = vectors.where("id < 100").collect()
    for r in found:
        assert isinstance(r["features"], SparseVector) and r["features"].size == 20_001
        assert len(r["features"].indices) <= 2
        assert [(int(i), v) for i, v in zip(r["features"].indices, r["features"].values)] == [tuple(s) for s in r["slots"]]
    # The index is joined, and no Python runs per row.
    plan = fitted.slots(wide)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Python" not in plan


def test_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    fitted = sparse.fit_sparse(empty, CONFIG, str(tmp_path))
    assert fitted.slots(empty).count() == 0 and fitted.width == 2


def test_gradient_tells_an_optimum_from_another_point(spark, rows, tmp_path):
    data = spark.range(600).selectExpr(
        "id", "cast((id * 7919) % 10 < id % 5 + 2 as double) as label", "concat('g', id % 5) as g", "cast(id % 13 as double) as x"
    )
    vectors = sparse.fit_sparse(data, CONFIG, str(tmp_path)).vectors(data)

    def steepest(iterations):
        estimator = LogisticRegression(regParam=0.01, standardization=False, maxIter=iterations, tol=1e-12)
        model = estimator.fit(vectors)
        gradient = evaluation.log_loss_gradient(model.transform(vectors), model)
        assert gradient.count() == 7
        return gradient.agg(F.max(F.abs("gradient"))).first()[0]

    assert steepest(300) < 1e-6 < 1e-3 < steepest(1)
    scaled = LogisticRegression(regParam=0.01).fit(vectors)
    with pytest.raises(ValueError, match="plain coefficients"):
        evaluation.log_loss_gradient(scaled.transform(vectors), scaled)


def test_flow_on_wide_categories(spark, tmp_path):
    customers = spark.range(400).selectExpr(
        "id as key", "cast(id % 3 = 0 as int) as churn", "concat('c', id % 3, '-', id % 60) as city", "cast(id % 11 as double) as spend"
    )
    feature = FeatureConfig(key="key", label="churn", wide=True)
    home = Home(str(tmp_path))
    result = train_and_promote(spark, customers, home, "churn", CleanConfig(), feature, TrainConfig("lr"))
    assert result.promoted and result.model_uid.startswith("wide_") and result.metrics["accuracy"] > 0.95
    scored = score_with_champion(spark, customers.drop("churn"), home, "churn", CleanConfig(), feature)
    right = scored.join(customers, "key").where(F.col("prediction") == F.col("churn")).count()
    assert scored.count() == 400 and right > 380


def test_slots_equal_the_dense_path_before_scaling(spark, rows):
    plain = rows.dropna(subset=["g", "a b"])
    encoded = features.one_hot(plain, ["g", "a b"])
    dense = {r["id"]: [*r["g_vec"].toArray(), *r["a b_vec"].toArray()] for r in encoded.collect()}
    long = {}
    for r in features.one_hot_slots(plain, ["g", "a b"], ["id"]).collect():
        long.setdefault(r["id"], set()).add(r["slot"])
    assert {i: {k for k, v in enumerate(x) if v} for i, x in dense.items()} == long


@pytest.mark.parametrize("narrow", [4, 6])
def test_weights_kept_as_a_table_are_those_of_the_dense_fit(spark, tmp_path, narrow):
    data = spark.range(900).selectExpr(
        "id", "cast((id * 7919) % 10 < id % 5 + 2 as double) as label", "if(id % 50 = 3, null, concat('g', id % 5)) as g",
        "concat('c', id * 31 % 7) as c", "cast(id % 13 as double) as x",
    )
    fitted = sparse.fit_sparse(data, CONFIG, str(tmp_path / "f"))
    logistic.fit_logistic(data, fitted, str(tmp_path / "m"), 0.01, tol=1e-10, narrow=narrow)
    model = logistic.load_logistic(spark, fitted, str(tmp_path / "m"))
    estimator = LogisticRegression(regParam=0.01, standardization=False, maxIter=500, tol=1e-13)
    dense = estimator.fit(fitted.vectors(data))
    got = {r["slot"]: r["weight"] for r in model.weights(spark).collect()}
    assert len(got) == fitted.width + 1 and got.pop(-1) == pytest.approx(dense.intercept, abs=1e-5)
    assert [got[i] for i in range(fitted.width)] == pytest.approx(list(dense.coefficients), abs=1e-5)
    scored = model.transform(data)
    theirs = dense.transform(fitted.vectors(data)).select("id", F.col("prediction").alias("theirs"))
    assert scored.count() == 900 and scored.join(theirs, "id").where("prediction <> theirs").isEmpty()
    gradient = evaluation.log_loss_gradient(scored, model)
    assert gradient.count() == fitted.width + 1 and gradient.agg(F.max(F.abs("gradient"))).first()[0] < 1e-9


def test_no_weight_of_a_wide_category_is_on_the_driver(spark, tmp_path):
    data = spark.range(3000).selectExpr("id", "cast(id % 3 = 0 as double) as label", "concat('g', id % 2000) as g", "cast(id % 13 as double) as x")
    model = logistic.fit_logistic(data, sparse.fit_sparse(data, CONFIG, str(tmp_path / "f")), str(tmp_path / "m"), 0.01)
    assert model.features.width == 2001 and [s for s, _ in model.near] == [-1, 2000]
    assert "LocalTableScan" not in evaluation.log_loss_gradient(model.transform(data), model)._jdf.queryExecution().toString()


def test_a_fit_needs_labels_and_a_penalty(spark, rows, tmp_path):
    fitted = sparse.fit_sparse(rows, CONFIG, str(tmp_path / "f"))
    with pytest.raises(ValueError, match="penalty"):
        logistic.fit_logistic(rows, fitted, str(tmp_path / "m"), 0.0)
    unlabelled = rows.withColumn("label", F.expr("nullif(label, 1)"))
    with pytest.raises(ValueError, match="3 of 5 rows"):
        logistic.fit_logistic(unlabelled, fitted, str(tmp_path / "m"), 0.01)
