"""A table kept by a stream without writing it anew: deltas by batch number, merged on read, compacted by bucket.

`delta/batch=N/bucket=B` holds what micro-batch N brought, `base/bucket=B/upto=N` a bucket's rows merged up to batch N.
A batch that is written again replaces its own files and nothing else, so a replay changes nothing; a batch writes
about its own rows, and every `every` batches the buckets that these touched are merged. A merge is marked under `done/N`
once it is whole: deltas up to the last mark are in the base, so readers open those after it, and `vacuum` removes what
the mark before the last has made idle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlens.sources.tables import there


@dataclass
class Deltas:
    """A table under path with one row per key. Rows of a key are merged by `first` (the first in that order stays) or, if
    `sums` names columns, by adding those up (and taking the largest of `most`)."""

    path: str
    schema: str
    key: list[str]
    first: list[Column] | None = None
    sums: tuple[str, ...] = ()
    most: tuple[str, ...] = ()
    buckets: int = 16
    every: int = 8

    def merged(self, rows: DataFrame) -> DataFrame:
        """One row per key, in any part of the table."""
        if self.sums:
            return rows.groupBy(*self.key).agg(*[F.sum(c).alias(c) for c in self.sums], *[F.max(c).alias(c) for c in self.most])
        return rows.withColumn("_k", F.row_number().over(Window.partitionBy(*self.key).orderBy(*self.first))).where("_k = 1").drop("_k")

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _part(self, spark: SparkSession, name: str, more: str) -> DataFrame:
        schema = f"{self.schema}, {more}"
        at = f"{self.path}/{name}"
        return spark.read.schema(schema).parquet(at) if there(spark, at) else spark.createDataFrame([], schema)

    def _numbers(self, spark: SparkSession, name: str, below: int) -> list[int]:
        """Batch numbers of the folders under a part: their names are all that is read."""
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [x.getPath().getName() for x in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(n for n in (int(x.split("=")[-1]) for x in names if x.split("=")[-1].isdigit()) if n < below)

    def _rows(self, spark: SparkSession, below: int) -> tuple[DataFrame, DataFrame]:
        """Base rows of each bucket's newest version, and deltas after it; of batches below the number."""
        done = max(self._numbers(spark, "done", below), default=-1)
        base = self._part(spark, "base", "bucket int, upto long").where(F.col("upto") < below)
        newest = base.groupBy("bucket").agg(F.max("upto").alias("_upto"))
        base = base.join(F.broadcast(newest), "bucket").where("upto = _upto").drop("_upto", "upto")
        # a merge that broke off has newer versions of some buckets than of others
        deltas = self._part(spark, "delta", "batch long, bucket int").where((F.col("batch") < below) & (F.col("batch") > done))
        return base, deltas.join(F.broadcast(newest), "bucket", "left").where("_upto is null or batch > _upto").drop("_upto")

    def read(self, spark: SparkSession, below: int = 1 << 62) -> DataFrame:
        """The table as of the batches below the number: all by default."""
        base, deltas = self._rows(spark, below)
        return self.merged(base.unionByName(deltas.drop("batch")).drop("bucket"))

    def write(self, rows: DataFrame, number: int) -> None:
        """Take up micro-batch `number`."""
        spark = rows.sparkSession
        own = self.merged(rows).withColumn("bucket", self.bucket())
        # few files a batch: rows of a bucket go together
        own.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/delta/batch={number}")
        if number % self.every == self.every - 1:
            self.compact(spark, number)

    def compact(self, spark: SparkSession, number: int) -> None:
        """Merge the buckets that have had deltas since the last time into versions of this number. Versions of this very
        number come from a run that is repeated: they are made anew from the ones before."""
        base, deltas = self._rows(spark, number)
        own = self._part(spark, "delta", "batch long, bucket int").where(F.col("batch") == number)
        deltas = deltas.unionByName(own)
        touched = deltas.select("bucket").distinct()
        rows = base.unionByName(deltas.drop("batch")).join(F.broadcast(touched), "bucket", "left_semi")
        out = self.merged(rows.drop("bucket")).withColumns({"bucket": self.bucket(), "upto": F.lit(number).cast("long")})
        out.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "upto").parquet(f"{self.path}/base")
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/done/{number}")

    def vacuum(self, spark: SparkSession) -> None:
        """Remove deltas and versions that the last but one merge has made idle; a repeated batch or merge needs none of them."""
        done = self._numbers(spark, "done", 1 << 62)
        if len(done) < 2:
            return
        path = lambda x: spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{x}")
        fs = path("").getFileSystem(spark._jsc.hadoopConfiguration())
        for n in self._numbers(spark, "delta", done[-2] + 1):
            fs.delete(path(f"delta/batch={n}"), True)
        for bucket in self._numbers(spark, "base", 1 << 62):
            versions = self._numbers(spark, f"base/bucket={bucket}", done[-2] + 1)
            for n in versions[:-1]:
                fs.delete(path(f"base/bucket={bucket}/upto={n}"), True)
        for n in done[:-2]:
            fs.delete(path(f"done/{n}"), True)
