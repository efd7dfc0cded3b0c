import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.sources.files_stream import read_file_stream
from tidemark.streaming.ingest import ingest_available
from tidemark.streaming.upsert import UpsertTable, latest_per_key, upsert

SCHEMA = "id bigint, v string, seq int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(str(x) for x in r))


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def expect(batches):
    """Keyed rows by last write, and every row without a key."""
    keyed, unkeyed = {}, []
    for batch in batches:
        last = {}
        for row in batch:
            if row[0] is None:
                unkeyed.append(row)
            elif row[0] not in last or (row[2], row[1]) > (last[row[0]][2], last[row[0]][1]):
                last[row[0]] = row
        keyed.update(last)
    return sorted([*keyed.values(), *unkeyed], key=lambda r: tuple(str(x) for x in r))


A = [(1, "a", 1), (2, "b", 1), (2, "b2", 2), (None, "n", 1)]
B = [(2, "c", 1), (3, "d", 1), (None, "n", 1), (None, "m", 2)]
C = [(1, "z", 9), (4, "e", 1)]


def test_upsert_replaces_inserts_and_keeps_null_keys(spark):
    target = latest_per_key(frame(spark, A), ["id"], ["seq"])
    got = rows(upsert(target, frame(spark, B), ["id"], ["seq"]))
    assert got == expect([A, B])


def test_strict_mode_raises_on_repeated_keys(spark):
    with pytest.raises(Exception, match="several rows for one key"):
        latest_per_key(frame(spark, A), ["id"]).collect()
    assert latest_per_key(frame(spark, B), ["id"]).count() == 4


@pytest.mark.parametrize("compacts", [False, True])
def test_table_equals_replaying_the_batches(spark, tmp_path, compacts):
    table = UpsertTable(str(tmp_path / "t"), ("id",), ("seq",))
    for i, batch in enumerate((A, B, C)):
        table.apply(frame(spark, batch), i)
        if compacts:
            assert table.compact(spark) and not table.compact(spark)
        assert rows(table.read(spark)) == expect([A, B, C][: i + 1])
    # A replayed batch changes nothing.
    table.apply(frame(spark, C), 2)
    assert rows(table.read(spark)) == expect([A, B, C])
    assert table._bases(spark) == ([0, 1, 2] if compacts else [])


def test_uncommitted_directories_are_ignored(spark, tmp_path):
    table = UpsertTable(str(tmp_path / "t"), ("id",), ("seq",))
    table.apply(frame(spark, A), 0)
    table.apply(frame(spark, B), 1)
    name = table._changes(spark)[1][1]
    (tmp_path / "t" / "changes" / f"tidemark_part={name}" / "_SUCCESS").unlink()
    assert rows(table.read(spark)) == expect([A])
    table.apply(frame(spark, B), 1)
    assert rows(table.read(spark)) == expect([A, B])


@pytest.mark.parametrize("ids", [(0, 0), (3, 0)])
def test_another_stream_adds_to_the_table(spark, tmp_path, ids):
    table = UpsertTable(str(tmp_path / "t"), ("id",), ("seq",))
    table.apply(frame(spark, A), ids[0], "one")
    table.apply(frame(spark, B), ids[1], "two")
    assert rows(table.read(spark)) == expect([A, B])


def test_lost_checkpoint_loses_no_rows(spark, tmp_path):
    table = UpsertTable(str(tmp_path / "t"), ("id",), ("seq",))
    for number, batch in enumerate((A, B)):
        frame(spark, batch).write.parquet(str(tmp_path / f"in{number}"))
        stream = read_file_stream(spark, str(tmp_path / f"in{number}"), schema_path=str(tmp_path / f"schema{number}"))
        ingest_available(stream, table, str(tmp_path / f"cp{number}"))
    assert rows(table.read(spark)) == expect([A, B])
    assert len({stream for *_, stream in table._changes(spark)}) == 2


def test_columns_are_checked_and_taken_up(spark, tmp_path):
    table = UpsertTable(str(tmp_path / "t"), ("id",), ("seq",))
    table.apply(frame(spark, A), 0)
    before = table._changes(spark)
    for wrong in ("select 1L id, 2 seq", "select 1L id, 'x' v, 2L seq"):
        with pytest.raises(ValueError, match="columns missing"):
            table.apply(spark.sql(wrong), 1)
    assert table._changes(spark) == before
    table.apply(spark.sql("select 9L id, 'x' v, 2 seq, 'own' batch, 7 _rank, 8 _number, 9 _own"), 1)
    got = {r["id"]: (r["v"], r["batch"], r["_rank"], r["_number"], r["_own"]) for r in table.read(spark).collect()}
    assert got[9] == ("x", "own", 7, 8, 9) and got[1] == ("a", None, None, None, None)
    table.compact(spark)
    assert {r["id"] for r in table.read(spark).where("batch = 'own'").collect()} == {9}


def test_expire_keeps_the_current_rows(spark, tmp_path):
    table = UpsertTable(str(tmp_path / "t"), ("id",), ("seq",))
    for i, batch in enumerate((A, B, C)):
        table.apply(frame(spark, batch), i)
        table.compact(spark)
    assert table.expire(spark)
    # Of every bucket one copy is left, an untouched one from an earlier compaction.
    held = [(n, b) for n in table._bases(spark) for b in table._buckets_of(spark, "base", n)]
    assert sorted(held) == sorted((n, b) for b, n in table._live(spark).items())
    assert rows(table.read(spark)) == expect([A, B, C])
    # The last batch of the stream is still known.
    table.apply(frame(spark, C), 2)
    table.apply(frame(spark, [(1, "y", 1)]), 3)
    assert (1, "y", 1) in rows(table.read(spark))


def stamps(root):
    return {f: f.stat().st_mtime_ns for f in root.rglob("*.parquet")}


def test_untouched_buckets_are_not_rewritten(spark, tmp_path):
    table = UpsertTable(str(tmp_path / "t"), ("id",), ("seq",), buckets=8)
    first = [(i, "a", 1) for i in range(200)] + [(None, "n", 1)]
    table.apply(frame(spark, first), 0)
    assert table.compact(spark)
    before = stamps(tmp_path / "t" / "base")
    assert len(table._live(spark)) == 8
    table.apply(frame(spark, [(5, "b", 2)]), 1)
    assert table.compact(spark)
    live = table._live(spark)
    # One key touches one bucket: the new copy holds nothing else, and no older file has changed.
    assert sorted(live.values()) == [0] * 7 + [1] and table._buckets_of(spark, "base", 1) == [b for b in live if live[b]]
    after = stamps(tmp_path / "t" / "base")
    assert {f: t for f, t in after.items() if f in before} == before and len(after) > len(before)
    assert rows(table.read(spark)) == expect([first, [(5, "b", 2)]])
    assert any("tidemark_part=0" in p for p in table.expire(spark))
    assert rows(table.read(spark)) == expect([first, [(5, "b", 2)]])


def test_reading_moves_neither_the_copy_nor_the_changes(spark, tmp_path):
    table = UpsertTable(str(tmp_path / "t"), ("id",), ("seq",), buckets=8)
    for number in range(3):
        table.apply(frame(spark, [(i, f"v{number}", number) for i in range(number, 300, number + 1)]), number)
        if number == 0:
            table.compact(spark)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        current = table.read(spark)
        assert len(rows(current)) == 300
        plan = current._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, kept)
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan
    assert "Exchange" not in plan.split("== Initial Plan ==")[0]


def test_many_columns_in_the_key_and_other_formats(spark, tmp_path):
    schema = "`a b` string, k bigint, v string, seq int"
    for fmt in ("orc", "json"):
        table = UpsertTable(str(tmp_path / fmt), ("a b", "k"), ("seq",), fmt=fmt, buckets=3)
        one = [("x", 1, "p", 1), ("x", 2, "q", 1), ("x", None, "r", 1), (None, 1, "s", 1)]
        two = [("x", 1, "t", 2), ("y", 1, "u", 1)]
        table.apply(spark.createDataFrame(one, schema), 0)
        table.compact(spark)
        table.apply(spark.createDataFrame(two, schema), 1)
        got = {(r["a b"], r["k"], r["v"]) for r in table.read(spark).collect()}
        assert got == {("x", 1, "t"), ("x", 2, "q"), ("x", None, "r"), (None, 1, "s"), ("y", 1, "u")}


def test_number_of_buckets_is_kept(spark, tmp_path):
    UpsertTable(str(tmp_path / "t"), ("id",), buckets=4).apply(frame(spark, B[:2]), 0)
    with pytest.raises(ValueError, match="has 4 buckets"):
        UpsertTable(str(tmp_path / "t"), ("id",), buckets=5).apply(frame(spark, B[:1]), 1)


def test_upsert_reads_target_once_and_source_for_keys_and_rows(spark, tmp_path):
    for name, data in (("a", A), ("b", B)):
        frame(spark, data).write.parquet(str(tmp_path / name))
    target, source = (spark.read.parquet(str(tmp_path / n)) for n in "ab")
    plan = upsert(target, source, ["id"], ["seq"])._jdf.queryExecution().optimizedPlan()
    assert plan.collectLeaves().size() == 3


def test_reading_nothing_raises(spark, tmp_path):
    with pytest.raises(ValueError, match="no committed table"):
        UpsertTable(str(tmp_path / "t"), ("id",)).read(spark)


def test_stream_takes_each_drop_once(spark, tmp_path):
    table = UpsertTable(str(tmp_path / "t"), ("id",), ("seq",))

    def run():
        stream = read_file_stream(
            spark, str(tmp_path / "in"), schema_path=str(tmp_path / "schema"), max_files_per_batch=1
        )
        ingest_available(stream, table, str(tmp_path / "cp"))
        return rows(table.read(spark))

    frame(spark, A).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == expect([A])
    frame(spark, B).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    frame(spark, C).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == expect([A, B, C])
    versions = (table._bases(spark), table._changes(spark))
    assert run() == expect([A, B, C])
    assert (table._bases(spark), table._changes(spark)) == versions


def test_delta_merge_statement_parses(spark):
    from tidemark.streaming.delta import merge_statement

    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(
        merge_statement("/data/t", ("id", "part"), "batch")
    )
    assert "MergeIntoTable" in plan.toString()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.lists(
            st.tuples(
                st.one_of(st.none(), st.integers(0, 4)), st.sampled_from("xyz"), st.integers(0, 3)
            ),
            min_size=1,
            max_size=8,
        ),
        min_size=2,
        max_size=2,
    )
)
def test_upsert_property(spark, batches):
    first, second = batches
    target = latest_per_key(frame(spark, first), ["id"], ["seq"])
    assert rows(upsert(target, frame(spark, second), ["id"], ["seq"])) == expect([first, second])
