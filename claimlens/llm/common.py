"""What the training-data operators share: reading, cutting lineage, words, distributed ranks."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of anything but blanks (space, tab, line feed, vertical tab, form feed, return).
WORD = r"[^\x20\x09-\x0D]+"

_own_dir: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir). Only a local session, as in tests, gets a temporary one where
    that is unset: on a cluster each executor would write to its own disk."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir is unset: executors need a shared folder")
    if not _own_dir:
        _own_dir.append(f"file://{tempfile.mkdtemp(prefix='spark-')}")
    return _own_dir[0]


def saved(df: DataFrame) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back.

    Cuts the lineage, and the files outlive any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/claimlens/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def byte_length(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bucket_of(h: Column, n: Column) -> Column:
    """Which of n equal ranges of the signed 64-bit hash h falls into; order is kept."""
    unit = (F.shiftright(h, 11) + F.lit(1 << 52)) / F.lit(float(1 << 53))
    return F.least(F.floor(unit * n), n - 1).cast("long")


def spread(count: Column, least: int = 64) -> Column:
    """Into how many sub-buckets to split a group of so many rows: about sqrt(count) each, at least `least`."""
    return F.greatest(F.ceil(count / F.greatest(F.lit(float(least)), F.sqrt(count.cast("double")))), F.lit(1)).cast("long")


def running(keys: list[str], order: list[str]) -> Window:
    """Everything before the current row."""
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
