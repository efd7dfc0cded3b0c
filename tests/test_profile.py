import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tidemark.operators import dashboard, profile, quantiles

SLOW = dict(deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_corr_skips_gaps_and_constants(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (None, 9.0, 5.0), (4.0, 7.7, 5.0)]
    df = spark.createDataFrame(rows, "x double, y double, k double")
    got = {r["column"]: r["abs_corr"] for r in profile.corr_with_label(df, "y", ["x", "k"]).collect()}
    assert got["x"] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4.1, 7.7])[0, 1])
    assert got["k"] is None
    zero = profile.corr_with_label(df, "y", ["x"], nulls_as_zero=True).first()["abs_corr"]
    assert zero == pytest.approx(abs(np.corrcoef([1, 2, 0, 4], [2, 4.1, 9.0, 7.7])[0, 1]))


def test_corr_matrix_equals_pandas(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame(rng.normal(size=(60, 4)), columns=list("abcd"))
    frame["d"] = 3.0
    frame.loc[5, "b"] = math.nan
    got = profile.corr_matrix(spark.createDataFrame(frame), list("abcd")).toPandas()
    assert len(got) == 16
    want = frame.corr()
    for _, row in got.iterrows():
        expected = want.loc[row["x"], row["y"]]
        if math.isnan(expected):
            assert math.isnan(row["r"])
        else:
            assert row["r"] == pytest.approx(expected)


def test_describe_keeps_types(spark):
    df = spark.createDataFrame([(1, "b"), (3, "a"), (None, None)], "n int, s string")
    got = {r["column"]: r for r in profile.describe(df).collect()}
    assert (got["n"]["count"], got["n"]["mean"], got["n"]["min_value"], got["n"]["max_value"]) == (2, 2, 1, 3)
    assert got["n"]["stddev"] == pytest.approx(math.sqrt(2))
    assert (got["s"]["count"], got["s"]["min_text"], got["s"]["max_text"]) == (2, "a", "b")


def test_rate_by_category_counts_null_category(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), (None, 1)], "g string, y int")
    got = [(r["category"], r["y_rate"], r["count"]) for r in profile.rate_by_category(df, "y", ["g"]).collect()]
    assert got == [(None, 1.0, 1), ("a", 0.5, 2)]


@settings(max_examples=8, **SLOW)
@given(
    st.lists(
        st.tuples(st.integers(0, 1), st.one_of(st.none(), st.integers(-5, 5).map(float))),
        min_size=1,
        max_size=40,
    ),
    st.sampled_from([2, 3, 128]),
)
def test_exact_quantiles_equal_numpy(spark, rows, bins):
    df = spark.createDataFrame(rows, "y int, v double")
    counts = quantiles.value_counts(df, ["y"], ["v"])
    probabilities = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = {
        r["y"]: r["quantiles"]
        for r in quantiles.exact_quantiles(counts, ["y", "column"], probabilities, bins).collect()
    }
    want = {}
    for label in (0, 1):
        values = [v for y, v in rows if y == label and v is not None]
        if values:
            want[label] = np.quantile(values, probabilities)
    assert got.keys() == want.keys()
    for label, expected in want.items():
        assert got[label] == pytest.approx(list(expected))


def test_exact_quantiles_with_one_value_in_a_third_of_rows(spark):
    df = spark.range(3000).selectExpr(
        "0 as y", "cast(if(id % 3 = 0, 7, (id * 7919) % 2003) as double) as v"
    )
    values = [7.0 if i % 3 == 0 else float((i * 7919) % 2003) for i in range(3000)]
    counts = quantiles.value_counts(df, ["y"], ["v"])
    got = quantiles.exact_quantiles(counts, ["y", "column"], (0.1, 0.25, 0.5, 0.75, 0.99)).first()
    assert got["quantiles"] == pytest.approx(list(np.quantile(values, (0.1, 0.25, 0.5, 0.75, 0.99))))


def test_box_stats_whiskers_and_outliers(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, math.nan, None]
    df = spark.createDataFrame([(0, v) for v in values], "y int, v double")
    row = quantiles.box_stats(df, "y", ["v"]).first()
    assert (row["q1"], row["median"], row["q3"]) == (2.25, 3.5, 4.75)
    assert (row["whisker_low"], row["whisker_high"], row["outliers"]) == (1.0, 5.0, 1)
    rough = quantiles.box_stats(df, "y", ["v"], exact=False).first()
    assert rough["median"] in (3.0, 4.0)


def test_box_stats_take_any_label_and_skip_missing_ones(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 9.0), ("b", 2.0)], "y string, v double")
    got = {r["y"]: r["median"] for r in quantiles.box_stats(df, "y", ["v"]).collect()}
    assert got == {"a": 1.0, "b": 2.0}


def test_corr_matrix_of_many_columns_is_one_scan(spark, tmp_path):
    columns = [f"v.{i}" for i in range(40)]
    rows = [tuple(float((i * r * r + r) % 13) for i in range(40)) for r in range(30)]
    spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in columns)).write.parquet(str(tmp_path / "t"))
    result = profile.corr_matrix(spark.read.parquet(str(tmp_path / "t")), columns)
    assert result._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = {(r["x"], r["y"]): r["r"] for r in result.collect()}
    assert len(got) == 1600 and all(abs(got[x, y] - got[y, x]) < 1e-9 for x, y in got)


def shuffled_rows(df):
    """Rows that each shuffle of the finished plan has written, by the plan's own metrics."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_quantiles_shuffle_only_what_lies_in_a_bracket(spark):
    """30,000 different values, of which a bracket of accuracy 500 holds 4 in 500 for each quartile."""
    df = spark.range(30_000).selectExpr("0 as y", "cast((id * 7919) % 30011 as double) as v").repartition(4)
    rows = quantiles.values(df.cache(), ["y"], ["v"])
    got = quantiles.exact_quantiles(rows, ["y", "column"], (0.25, 0.5, 0.75), accuracy=500)
    moved = shuffled_rows(got)
    assert moved and sum(moved) < 3 * 30_000 * 4 / 500 * 2.5
    want = np.quantile([float(i * 7919 % 30011) for i in range(30_000)], (0.25, 0.5, 0.75))
    assert got.first()["quantiles"] == pytest.approx(list(want))


def test_box_stats_shuffle_no_values(spark):
    df = spark.range(20_000).selectExpr("id % 2 as y", "cast((id * 7919) % 20011 as double) as v").repartition(4).cache()
    assert sum(shuffled_rows(quantiles.box_stats(df, "y", ["v"]))) < 200


def test_a_sketch_that_misses_costs_no_exactness(spark, monkeypatch):
    df = spark.range(2000).selectExpr("0 as y", "cast(id as double) as v")
    honest = F.percentile_approx
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda *_: honest("value", [0.99] * 2, 10))
    rows = quantiles.values(df, ["y"], ["v"])
    assert quantiles.exact_quantiles(rows, ["y", "column"], (0.5,)).first()["quantiles"] == [999.5]


def test_hist_puts_maximum_in_last_bin_and_skips_gaps(spark):
    rows = [(0, float(v), 3.0) for v in range(11)] + [(1, None, 3.0), (1, math.nan, 3.0)]
    df = spark.createDataFrame(rows, "y int, v double, k double")
    got = {
        (r["y"], r["column"], r["bin"]): r["count"]
        for r in profile.hist_by_label(df, "y", ["v", "k"], bins=5).collect()
    }
    assert got[(0, "v", 4)] == 3
    assert sum(n for (_, c, _), n in got.items() if c == "v") == 11
    assert got[(0, "k", 0)] == 11 and got[(1, "k", 0)] == 2


def test_kpis_of_no_rows(spark):
    df = spark.createDataFrame([], "y int, t int, s double")
    row = dashboard.kpi_metrics(df, "y", "t", "s").first()
    assert (row["total_customers"], row["churned_customers"], row["churn_rate"]) == (0, 0, None)


def test_schema_report(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    got = {r["name"]: (r["type"], r["nullable"], r["row_count"]) for r in profile.schema_report(df).collect()}
    assert got == {"n": ("int", True, 1), "s": ("string", True, 1)}
