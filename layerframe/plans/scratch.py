"""Written intermediate tables.

A table in the shared folder cuts lineage and survives lost executors, which is
what the few multi-pass plans here need.  The folder is the one the cluster names
in ``spark.checkpoint.dir``; only a local session without that setting gets a
temporary folder.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
_written: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark).rstrip('/')}/layerframe/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def drop_scratch(spark: SparkSession) -> None:
    """Deletes what this process has written so far; no DataFrame built from it may be in use."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    while _written:
        path = hadoop(_written.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and returns a scan of what was written."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
