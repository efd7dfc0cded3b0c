import pytest

from tidemark.defaults import AGE_BINS, TENURE_BINS
from tidemark.functions import BinLabel, BinSpec
from tidemark.operators import derive, engagement, split

EDGES = [39, 40, 65, 66, 3, 12, 24, 25, None]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(v,) for v in EDGES], "a int")


def labels(df, column):
    return {r["a"]: r[column] for r in df.collect()}


def test_first_matching_label_wins(edges):
    got = derive.bin_columns(edges, [BinSpec("a", AGE_BINS)])
    age = labels(got, "a_category")
    assert [age[v] for v in (39, 40, 65, 66, None)] == [
        "Young", "Middle-Aged", "Middle-Aged", "Senior", None,
    ]
    tenure = labels(derive.bin_columns(edges, [BinSpec("a", TENURE_BINS)]), "a_category")
    assert [tenure[v] for v in (3, 12, 24, 25, None)] == [
        "Early-Stage", "Early-Stage", "Mid-term", "Loyal", None,
    ]


def test_no_specs_return_the_input(edges):
    assert derive.bin_columns(edges, []) is edges


def test_spec_from_mapping():
    spec = BinSpec.from_mapping(
        {"col_name": "Age", "labels": [{"name": "Young", "start": "null", "end": 40},
                                       {"name": "Old", "start": 40, "end": "null"}]}
    )
    assert spec == BinSpec("Age", (BinLabel("Young", None, 40), BinLabel("Old", 40, None)))
    assert spec.output == "Age_category"


def test_fixed_bins_at_edges_and_null(edges, spark):
    age = labels(derive.bin_age(edges, "a", "o"), "o")
    assert [age[v] for v in (39, 40, 65, None)] == ["Young", "Middle-Aged", "Senior", "Senior"]
    tenure = labels(derive.bin_tenure(edges, "a", "o"), "o")
    assert [tenure[v] for v in (3, 12, 24, 25, None)] == [
        "New", "Early-Stage", "Mid-term", "Loyal", "Loyal",
    ]
    money = spark.createDataFrame([(v,) for v in (0, -5, 49_999, 50_000, 100_000, None)], "a int")
    balance = labels(derive.bin_balance(money, "a", "o"), "o")
    assert [balance[v] for v in (0, -5, 49_999, 50_000, 100_000, None)] == [
        "Zero", "Low", "Low", "Medium", "High", "High",
    ]
    points = spark.createDataFrame([(v,) for v in (599, 600, 700, 800, None)], "a int")
    score = labels(derive.bin_score(points, "a", "o"), "o")
    assert [score[v] for v in (599, 600, 700, 800, None)] == [
        "Poor", "Fair", "Good", "Excellent", "Excellent",
    ]


def test_ratio_with_zero_divisor(spark):
    df = spark.createDataFrame([(6, 3), (6, 0), (6, None), (None, 2)], "x int, y int")
    got = [r["x_y_ratio"] for r in derive.ratio_column(df, "x", "y").collect()]
    assert got == [2.0, 6.0, None, None]


def test_engagement_by_hand(spark):
    events = spark.createDataFrame(
        [
            (1, "2024-01-01 08:00:00", "view"),
            (1, "2024-01-01 09:00:00", "click"),
            (1, "2024-01-02 09:00:00", "view"),
            (1, "2024-01-05 09:00:00", "view"),
            (2, "2024-01-02 09:00:00", "view"),
            (9, "2024-01-06 09:00:00", "error"),
        ],
        "user_id bigint, ts string, event_type string",
    ).selectExpr("user_id", "cast(ts as timestamp_ntz) as ts", "event_type")
    segments = spark.createDataFrame([(1, "A"), (2, "A")], "user_id bigint, segment string")
    row = engagement.engagement_inputs(
        events, segments, "user_id", "ts", "event_type", "segment"
    ).first()
    assert row["adoption"] == pytest.approx((2 / 3 + 1 / 3) / 2)
    # Daily users 1, 2, 1 on three active days; two weekly users.
    assert row["stickiness"] == pytest.approx((4 / 3) / 2)
    # Streak starts: user 1 on the 1st and 5th, user 2 on the 2nd. Ends: 2nd, 5th, 2nd.
    assert row["growth"] == pytest.approx(3 / 3)
    assert derive.engagement_score(
        spark.createDataFrame([(0.5, 0.5, 2.0)], "adoption double, stickiness double, growth double")
    ).first()["engagement_score"] == 0.5


def test_hash_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(2000).selectExpr("id as k")
    train, test = split.split_by_hash(df, "k")
    a = {r["k"] for r in train.collect()}
    b = {r["k"] for r in test.collect()}
    assert not a & b and len(a) + len(b) == 2000
    assert 1500 < len(a) < 1700
    again, _ = split.split_by_hash(df.repartition(7), "k")
    assert {r["k"] for r in again.collect()} == a


def test_hash_split_takes_fine_ratios(spark):
    _, test = split.split_by_hash(spark.range(20_000).selectExpr("id as k"), "k", ratio=0.125)
    assert 2_300 < test.count() < 2_700


def test_hash_split_keeps_null_keys(spark):
    df = spark.createDataFrame([(None,), (1,)], "k int")
    train, test = split.split_by_hash(df, "k")
    assert train.count() + test.count() == 2


def test_random_split_covers_the_input(spark):
    df = spark.range(500)
    train, test = split.split_random(df)
    assert sorted(r["id"] for r in train.union(test).collect()) == list(range(500))


def test_sample_is_a_subset(spark):
    got = [r["id"] for r in split.sample(spark.range(5000), 0.1).collect()]
    assert 300 < len(got) < 700 and len(set(got)) == len(got)
