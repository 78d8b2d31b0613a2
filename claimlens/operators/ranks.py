"""Exact ranks and quantiles of any number of rows: ranges of the sort order are counted, so no task sorts a whole group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.sources.tables import written


def running(df: DataFrame, by: list[str], order: list[Column | str], weight: Column | None = None, name: str = "_rank") -> DataFrame:
    """`name`: how many rows (or how much weight) of the same group come up to each row in the given order, itself
    included; without a weight that is the row's rank from 1. Order by columns that tell rows apart.

    Rows are dealt by ranges of group and order, so a hot group lies in many parts; what the parts before hold is added.
    The parts are written first: ranges are drawn anew when a lost part is computed again."""
    weight = F.lit(1) if weight is None else weight
    sums, at = "_before", "_range"
    parts = written(df.repartitionByRange(*by, *order).withColumn(at, F.spark_partition_id()))
    per = parts.groupBy(*by, at).agg(F.sum(weight).alias(sums))
    # as many rows as parts and groups
    earlier = Window.partitionBy(*(by or [F.lit(1)])).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn(sums, F.coalesce(F.sum(sums).over(earlier), F.lit(0)))
    upto = Window.partitionBy(*by, at).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    other = per.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col(at).alias("_at"), sums)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by], F.col(at) == F.col("_at"))
    out = parts.withColumn(name, F.sum(weight).over(upto)).join(other, same)
    return out.withColumn(name, F.col(name) + F.col(sums)).drop(at, "_at", sums, *[f"_by_{c}" for c in by])


def quantiles(df: DataFrame, columns: dict[str, Column], points: list[float], weight: Column | None = None) -> DataFrame:
    """One row: for each name the array of its column's exact quantiles at the points, interpolated linearly; null
    without values. Nulls don't count; weight: how many values a row stands for."""
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("_name"), c.cast("double").alias("_v")) for n, c in columns.items()])).alias("_x")
    weight = F.lit(1) if weight is None else weight
    counts = df.select(cells, weight.alias("_w")).select("_x.*", "_w").where("_v is not null").groupBy("_name", "_v").agg(F.sum("_w").alias("_c"))
    ranked = running(counts, ["_name"], [F.col("_v")], F.col("_c"), "_upto")
    size = ranked.groupBy(F.col("_name").alias("_of")).agg(F.max("_upto").alias("_n"))
    ranked = ranked.join(F.broadcast(size), F.col("_name") == F.col("_of"))
    here = lambda k: (k < F.col("_upto")) & (k >= F.col("_upto") - F.col("_c"))
    value = lambda n, k: F.max(F.when((F.col("_name") == n) & here(k), F.col("_v")))

    def at(n: str, p: float) -> Column:
        k = F.lit(float(p)) * (F.col("_n") - 1)
        low, high = value(n, F.floor(k)), value(n, F.ceil(k))
        part = F.max(F.when(F.col("_name") == n, k - F.floor(k)))
        return low + part * (high - low)

    got = {n: [at(n, p) for p in points] for n in columns}
    return ranked.agg(*[F.when(F.count_if(F.col("_name") == n) > 0, F.array(*cs)).alias(n) for n, cs in got.items()])
