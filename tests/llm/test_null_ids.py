"""Contaminated rows without an id."""

import brute
from conftest import ITEM

from tidemark.llm.queries import QUERIES


def test_null_ids_keep_their_items(spark, tmp_path):
    rows = [(None, "head " + ITEM + " tail"), (None, "clean words"), (1, ITEM), (None, "other " + ITEM)]
    items = [("i1", ITEM), ("i2", "tail")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = [tuple(r) for r in QUERIES["op5_winnowing"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(brute.contaminated(rows, items), key=str)
