import pytest

from tidemark.operators import registry

RUNS = [
    ("old", "m0", "metric", "accuracy", "0.5"),
    ("above", "m1", "metric", "accuracy", "0.56"),
    ("equal", "m2", "metric", "accuracy", "0.55"),
    ("below", "m3", "metric", "accuracy", "0.54"),
    ("missing", "m4", "metric", "f1", "0.99"),
    ("null", "m5", "metric", "accuracy", None),
    ("above", "m1", "param", "accuracy", "not a number"),
]


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame(RUNS, registry.RUNS)


def decide(spark, runs, versions, run_id):
    known = spark.createDataFrame(versions, registry.REGISTRY)
    candidate = spark.createDataFrame([("churn", run_id)], "name string, run_id string")
    return registry.promotion_decisions(candidate, runs, known)


@pytest.mark.parametrize(
    ("run_id", "promoted"),
    [("above", True), ("below", False), ("missing", False), ("null", False)],
)
def test_challenger_must_beat_the_margin(spark, runs, run_id, promoted):
    row = decide(spark, runs, [("churn", 1, "old"), ("other", 9, "above")], run_id).first()
    assert row["promoted"] is promoted and row["next_version"] == 2


def test_equal_to_the_margin_is_not_enough(spark, runs):
    # 0.5 * (1 + 0.5) and 0.75 are exact in binary.
    known = spark.createDataFrame([("churn", 1, "old")], registry.REGISTRY)
    exact = spark.createDataFrame([("e", "m", "metric", "accuracy", "0.75")], registry.RUNS)
    candidate = spark.createDataFrame([("churn", "e")], "name string, run_id string")
    decisions = registry.promotion_decisions(candidate, runs.union(exact), known, margin=0.5)
    assert decisions.first()["promoted"] is False


def test_one_winner_per_name(spark, runs):
    candidates = spark.createDataFrame(
        [("churn", "above"), ("churn", "equal"), ("churn", "missing"), ("new", "missing"), ("new", "below")],
        "name string, run_id string",
    )
    known = spark.createDataFrame([("churn", 3, "old")], registry.REGISTRY)
    decisions = registry.promotion_decisions(candidates, runs, known, margin=0.05)
    got = sorted(tuple(r) for r in registry.promotions(decisions).collect())
    assert got == [("churn", 4, "above"), ("new", 1, "below")]


def test_first_model_is_registered_even_without_metric(spark, runs):
    decisions = decide(spark, runs, [], "missing")
    assert [tuple(r) for r in registry.promotions(decisions).collect()] == [("churn", 1, "missing")]


def test_newest_version_is_the_champion(spark, runs):
    versions = [("churn", 1, "above"), ("churn", 2, "old")]
    row = decide(spark, runs, versions, "above").first()
    assert (row["champion_run"], row["old_metric"], row["promoted"]) == ("old", 0.5, True)
    known = spark.createDataFrame(versions, registry.REGISTRY)
    assert registry.champion_model(runs, known, "churn") == (2, "m0")
    assert registry.champion_model(runs, known, "none") is None


def test_unknown_champion_metric_blocks(spark, runs):
    row = decide(spark, runs, [("churn", 1, "missing")], "above").first()
    assert row["promoted"] is False


def test_run_record(spark):
    got = registry.run_record(spark, "r", "m", {"p": "1"}, {"f1": 0.5, "gone": None}, {"t": "x"})
    assert {tuple(r) for r in got.collect()} == {
        ("r", "m", "param", "p", "1"),
        ("r", "m", "metric", "f1", "0.5"),
        ("r", "m", "metric", "gone", None),
        ("r", "m", "tag", "t", "x"),
    }
