"""CSV scans that account for what they could not read."""

import pytest

from tidemark.sources.batch import read_csv
from tidemark.sources.rejects import parsed_rows, read_csv_checked, rejected

SCHEMA = "id bigint, name string, n int, at timestamp, ok boolean, `d e` double"
LINES = [
    "id,name,n,at,ok,d e",
    "1,plain,5,2024-01-02 03:04:05,true,1.5",
    "2,,,,,",
    "3,bad,5x,yesterday,maybe,1.5e",
    "4,short,7",
    '5,"quoted, and ""so""",8,2024-01-02 03:04:05,false,-2',
    "6,long,9,2024-01-02 03:04:05,true,3,more,still more",
    "x7,key,99999999999,2024-01-02,true,NaN",
    '8,"two',
    'lines",1,2024-01-02 03:04:05,true,0',
]


@pytest.fixture(scope="module")
def checked(spark, tmp_path_factory):
    file = tmp_path_factory.mktemp("csv") / "in.csv"
    file.write_text("\n".join(LINES) + "\n")
    return read_csv_checked(spark, str(file), SCHEMA, multiLine="true"), str(file)


def test_every_reject_is_told_with_its_text(checked):
    got = sorted((str(r["id"]), str(r["column"]), r["text"], r["reason"]) for r in rejected(checked[0], ["id"]).collect())
    assert got == sorted(
        [
            ("3", "n", "5x", "field"),
            ("3", "at", "yesterday", "field"),
            ("3", "ok", "maybe", "field"),
            ("3", "d e", "1.5e", "field"),
            ("4", "None", "4,short,7", "line"),
            ("6", "None", "6,long,9,2024-01-02 03:04:05,true,3,more,still more", "line"),
            ("None", "id", "x7", "field"),
            ("None", "n", "99999999999", "field"),
        ]
    )


def test_rows_equal_a_permissive_scan(spark, checked):
    mine = parsed_rows(checked[0])
    plain = read_csv(spark, checked[1], SCHEMA, multiLine="true")
    assert mine.schema.simpleString() == plain.schema.simpleString()
    assert sorted(map(str, mine.collect())) == sorted(map(str, plain.collect()))
    assert sorted(r["id"] for r in parsed_rows(checked[0], whole=True).collect()) == [1, 2, 5, 8]


def test_one_pass_and_pruning_does_not_change_what_is_found(checked):
    only = rejected(checked[0])
    assert only.where("reason = 'line'").count() == 2
    assert only._jdf.queryExecution().executedPlan().toString().count("Scan csv") == 1


def test_formats_and_own_names(spark, tmp_path):
    (tmp_path / "d.csv").write_text("1,31.12.2023\n2,2023-12-31\n")
    found = read_csv_checked(spark, str(tmp_path / "d.csv"), "k int, d date", header=False, dateFormat="dd.MM.yyyy")
    assert [(r["column"], r["text"]) for r in rejected(found).collect()] == [("d", "2023-12-31")]
    with pytest.raises(ValueError, match="own"):
        read_csv_checked(spark, str(tmp_path / "d.csv"), "_rejects int")
