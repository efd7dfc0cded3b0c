"""Paths on the shared file system, through Hadoop so that any store works."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: list[tempfile.TemporaryDirectory] = []


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def is_committed(spark: SparkSession, path: str) -> bool:
    """True when a Spark write to this directory ran to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly below a directory; empty when it is absent."""
    if not exists(spark, path):
        return []
    return [s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path))]


def size_bytes(spark: SparkSession, path: str) -> int:
    return _fs(spark, path).getContentSummary(_path(spark, path)).getLength()


def delete(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).delete(_path(spark, path), True)


def workspace(spark: SparkSession) -> str:
    """A fresh directory below the shared folder named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder, because
    there driver and tasks share one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        holder = tempfile.TemporaryDirectory(prefix="tidemark-", ignore_cleanup_errors=True)
        _local_dirs.append(holder)
        root = holder.name
    return f"{root.rstrip('/')}/tidemark/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows written once below the shared folder and read back.

    What follows reads files of known size, and a result that steps share is computed once.
    """
    path = workspace(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage; keeps a directory that is already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(workspace(spark))
