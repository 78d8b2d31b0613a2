"""Ranks and quantiles over ranges against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlens.operators.ranks import quantiles, running


@pytest.mark.parametrize("hot", [0.0, 0.9])
def test_ranks_follow_the_order_within_each_group(spark, hot):
    r = random.Random(4)
    rows = [(i, "a" if r.random() < hot else r.choice(["a", "b", None]), r.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(r.sample(rows, len(rows)), "id long, g string, x int").repartition(5)
    got = {x.id: x._rank for x in running(df, ["g"], [F.col("x").desc(), F.col("id")]).collect()}
    seen, want = {}, {}
    for i, g, x in sorted(rows, key=lambda t: (-t[2], t[0])):
        seen[g] = seen.get(g, 0) + 1
        want[i] = seen[g]
    assert got == want


def test_ranks_without_groups_and_rows(spark):
    df = spark.range(50).withColumn("w", F.col("id") % 3)
    got = {x.id: x._rank for x in running(df, [], [F.col("id")], F.col("w")).collect()}
    assert got == {i: sum(k % 3 for k in range(i + 1)) for i in range(50)}
    assert running(df.where("id < 0"), [], [F.col("id")]).count() == 0


def test_quantiles_equal_numpy(spark):
    r = random.Random(8)
    rows = [(r.gauss(0, 3), float(r.randint(0, 2)), None if r.random() < 0.2 else r.random(), None) for _ in range(997)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(4)
    points = [0.0, 0.1, 0.5, 0.95, 1.0]
    got = quantiles(df, {c: F.col(c) for c in "abcd"}, points).first()
    for i, c in enumerate("abc"):
        assert np.allclose(got[c], np.quantile([x[i] for x in rows if x[i] is not None], points)), c
    assert got.d is None
    assert quantiles(df.where("a > 1000"), {"a": F.col("a")}, points).first().a is None


def test_weighted_quantiles_equal_numpy_of_repeated_rows(spark):
    r = random.Random(5)
    rows = [(r.randint(0, 40) / 8, r.randint(1, 9)) for _ in range(200)]
    got = quantiles(spark.createDataFrame(rows, "a double, w int").repartition(4), {"a": F.col("a")}, [0.05, 0.5, 0.95], F.col("w")).first()
    assert np.allclose(got.a, np.quantile([a for a, w in rows for _ in range(w)], [0.05, 0.5, 0.95]))
