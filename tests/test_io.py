import os

import pytest

from tidemark.sinks import publish_table, save, save_counted, save_if_absent
from tidemark.sources import files_stream, storage
from tidemark.sources.batch import read_catalog_table, read_csv, read_table


def files(path):
    return [f for f in os.listdir(path) if f.startswith("part-")]


def test_csv_inference_and_bad_fields(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,spend,name\n1,2.5,x\n2,oops,\n3,4,z\n")
    inferred = read_csv(spark, str(tmp_path))
    assert dict(inferred.dtypes) == {"id": "int", "spend": "string", "name": "string"}
    typed = read_csv(spark, str(tmp_path), schema="id int, spend double, name string")
    assert [tuple(r) for r in typed.orderBy("id").collect()] == [
        (1, 2.5, "x"), (2, None, None), (3, 4.0, "z"),
    ]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_formats_round_trip(spark, tmp_path, fmt):
    df = spark.range(10).selectExpr("id", "cast(id as string) as s")
    save(df, str(tmp_path / "t"), fmt=fmt)
    assert sorted(map(tuple, read_table(spark, str(tmp_path / "t"), fmt).select("id", "s").collect())) == [
        (i, str(i)) for i in range(10)
    ]


def test_repartition_sets_file_count(spark, tmp_path):
    save(spark.range(100), str(tmp_path / "t"), repartition=3)
    assert len(files(tmp_path / "t")) == 3


def test_partitioned_write_is_counted_and_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('k', id % 5)) as g", "id % 2 as h")
    assert save_counted(df, path, partitions=["g", "h"]) == 1000
    back = read_table(spark, path)
    assert back.where("g = 'hot'").count() == 334
    plan = back.where("g = 'hot'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(g" in plan
    assert len(files(tmp_path / "t" / "g=k1" / "h=0")) == 1


def test_partition_values_keep_their_type_with_a_schema(spark, tmp_path):
    df = spark.createDataFrame([(1, "01"), (2, "02")], "id int, zip string")
    save(df, str(tmp_path / "t"), partitions=["zip"])
    assert dict(read_table(spark, str(tmp_path / "t")).dtypes)["zip"] == "int"
    typed = read_table(spark, str(tmp_path / "t"), schema=df.schema)
    assert sorted(r["zip"] for r in typed.collect()) == ["01", "02"]


def test_count_leaves_fitted_models_usable(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors

    assert save_counted(spark.range(7), str(tmp_path / "t")) == 7
    rows = spark.createDataFrame(
        [(Vectors.dense(float(i)), float(i % 2)) for i in range(20)], ["features", "label"]
    )
    model = LogisticRegression(maxIter=2).fit(rows)
    assert len(model.transform(rows).select("prediction").collect()) == 20


def test_overwrite_and_create_if_absent(spark, tmp_path):
    path = str(tmp_path / "t")
    save_if_absent(spark.range(3), path)
    save_if_absent(spark.range(5), path)
    assert read_table(spark, path).count() == 3
    save(spark.range(5), path)
    assert read_table(spark, path).count() == 5


def test_publish_twice(spark, tmp_path):
    publish_table(spark.range(3), "tm_test_table", str(tmp_path / "a"))
    publish_table(spark.range(4), "tm_test_table", str(tmp_path / "b"))
    assert read_catalog_table(spark, "tm_test_table").count() == 4
    spark.sql("DROP TABLE tm_test_table")


def test_stream_schema_is_kept_and_extended(spark, tmp_path):
    data, schema = str(tmp_path / "in"), str(tmp_path / "schema")
    spark.range(3).write.parquet(data)
    first = files_stream.read_file_stream(spark, data, schema_path=schema)
    spark.range(3).selectExpr("cast(id as string) as other").write.mode("append").parquet(data)
    again = files_stream.read_file_stream(spark, data, schema_path=schema)
    assert first.isStreaming and first.schema.names == ["id"] and again.schema.names == ["id", "other"]
    with pytest.raises(ValueError):
        files_stream.read_file_stream(spark, data)


def test_storage_helpers(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not storage.is_committed(spark, path) and storage.list_names(spark, path) == []
    spark.range(3).write.parquet(path)
    assert storage.is_committed(spark, path) and "_SUCCESS" in storage.list_names(spark, path)
    assert storage.size_bytes(spark, path) > 0
    assert storage.delete(spark, path) and not storage.exists(spark, path)


def test_workspace_follows_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    first, second = storage.workspace(spark), storage.workspace(spark)
    assert first != second
    assert root is None or first.startswith(root)


def test_schema_takes_up_columns_and_refuses_other_types(spark, tmp_path):
    from tidemark.sources.files_stream import resolve_schema

    files, kept = str(tmp_path / "in"), str(tmp_path / "schema")
    spark.sql("select 1 a").write.parquet(files)
    assert resolve_schema(spark, files, "parquet", kept).names == ["a"]
    spark.sql("select 2 a, 'x' b").write.mode("append").parquet(files)
    assert resolve_schema(spark, files, "parquet", kept).names == ["a", "b"]
    assert resolve_schema(spark, files, "parquet", kept).names == ["a", "b"]
    spark.sql("select 'text' a").write.mode("overwrite").parquet(files)
    with pytest.raises(ValueError, match="another type"):
        resolve_schema(spark, files, "parquet", kept)


def test_publishing_refuses_a_managed_table(spark, tmp_path):
    from tidemark.sinks.batch import publish_location

    spark.range(2).write.mode("overwrite").saveAsTable("tidemark_managed")
    try:
        with pytest.raises(ValueError, match="managed"):
            publish_location(spark, "tidemark_managed", str(tmp_path))
    finally:
        spark.sql("DROP TABLE tidemark_managed")
