import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.defaults import CleanConfig
from tidemark.operators import clean, profile

NULL_MIX = [
    (1, 1, 10, 1.0, "a"),
    (2, None, None, None, None),
    (3, 0, 0, math.nan, ""),
    (4, 2, 5, 0.0, "NULL"),
    (5, 3, 6, 2.5, "null"),
    (6, 4, 7, 3.5, "Null"),
]


@pytest.fixture(scope="module")
def null_mix(spark):
    return spark.createDataFrame(NULL_MIX, "id bigint, i int, l bigint, d double, s string")


def test_null_profile_by_type(null_mix):
    got = {r["column"]: (r["null_count"], r["null_percent"]) for r in profile.null_profile(null_mix).collect()}
    assert {c: n for c, (n, _) in got.items()} == {"id": 0, "i": 1, "l": 1, "d": 2, "s": 4}
    assert got["d"][1] == pytest.approx(100 * 2 / 6)


def test_null_profile_of_no_rows(null_mix):
    rows = profile.null_profile(null_mix.where("id < 0")).collect()
    assert {r["null_count"] for r in rows} == {0}
    assert {r["null_percent"] for r in rows} == {None}


def test_null_profile_of_other_types(spark):
    df = spark.sql("select true as b, cast(null as decimal(9,2)) as m, date'2020-01-01' as t, array(1) as a")
    got = {r["column"]: r["null_count"] for r in profile.null_profile(df).collect()}
    assert got == {"b": 0, "m": 1, "t": 0, "a": 0}


def test_column_names_with_spaces_and_dots(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "`Support Calls` int, `a.b` string")
    got = {r["column"]: r["null_count"] for r in profile.null_profile(df).collect()}
    assert got == {"Support Calls": 0, "a.b": 1}
    assert clean.drop_missing_rows(df, ["a.b"]).count() == 1
    assert clean.deduplicate(df, ["a.b"], ["Support Calls"]).count() == 2
    assert clean.normalise_names(df.select("Support Calls")).columns == ["Support_Calls"]


def test_dropna_drops_nan_keeps_blank_strings(null_mix):
    kept = clean.drop_missing_rows(null_mix, ["d"]).collect()
    assert sorted(r["id"] for r in kept) == [1, 4, 5, 6]
    kept = clean.drop_missing_rows(null_mix, ["s"]).collect()
    assert sorted(r["id"] for r in kept) == [1, 3, 4, 5, 6]
    assert clean.drop_missing_rows(null_mix, []).count() == len(NULL_MIX)


def test_missing_rows(null_mix):
    assert sorted(r["id"] for r in clean.missing_rows(null_mix, "s").collect()) == [2, 3, 4, 5]


def test_drop_ignores_unknown_names(null_mix):
    assert clean.drop_columns(null_mix, ["i", "nope"]).columns == ["id", "l", "d", "s"]
    assert clean.drop_columns(null_mix).columns == null_mix.columns


def test_dedup_with_empty_list_means_all_columns(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "k int, v string")
    assert clean.deduplicate(df, []).count() == 2


def test_dedup_subset_keeps_first_in_order(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (2, None, 1)], "k int, v string, n int")
    got = {tuple(r) for r in clean.deduplicate(df, ["k"], ["n"]).collect()}
    assert got == {(1, "b", 2), (2, None, 1)}
    got = {tuple(r) for r in clean.deduplicate(df, ["k"]).collect()}
    assert got == {(1, "a", 3), (2, None, 1)}


def test_dedup_subset_with_a_map_column(spark):
    df = spark.sql("select 1 as k, 2 as n, map('a', 1) as m union all select 1, 1, map('b', 2)")
    assert [(r["n"], r["m"]) for r in clean.deduplicate(df, ["k"], ["n"]).collect()] == [(1, {"b": 2})]


def test_dropping_the_key_first_collapses_equal_customers(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (2, "a"), (3, None)], "id int, v string")
    by_default = clean.clean(df, CleanConfig(drop=("id",), dropna=("v",)))
    assert by_default.count() == 1
    dedup_first = clean.clean(df, CleanConfig(drop=("id",), dropna=("v",), dedup_first=True))
    assert dedup_first.count() == 2


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2)), min_size=1, max_size=30))
def test_dedup_is_idempotent(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int")
    once = clean.deduplicate(df, ["k"])
    assert sorted(once.collect()) == sorted(clean.deduplicate(once, ["k"]).collect())
    assert sorted(map(tuple, clean.deduplicate(df).collect())) == sorted(set(rows))


def test_hot_key_is_pruned_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 as k", "id as v")
    plan = clean.deduplicate(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
