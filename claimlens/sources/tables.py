"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir). Only a local session, as in tests, gets a
    temporary one where that is unset: on a cluster each executor would write to its own disk."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir is unset: executors need a shared folder")
    if not _own:
        _own.append(f"file://{tempfile.mkdtemp(prefix='spark-')}")
    return _own[0]


def written(df: DataFrame) -> DataFrame:
    """df written as Parquet in the shared folder and read back: what several later branches use is computed once, and
    the files outlive any executor."""
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def there(spark: SparkSession, path: str) -> bool:
    """Whether the path holds anything, in whatever store it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(at)
