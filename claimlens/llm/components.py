"""Connected components of a table of links, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> node, comp: the smallest node reachable, for every node of a link.

    Every round hooks each tree's root to the smallest label next to the tree and then shortens all paths,
    so the rounds grow with the logarithm of the size. A node with many links is only ever grouped with
    partial sums or joined, never gathered."""
    pairs = links.select("a", "b").where("a <> b")
    edges = saved(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = saved(edges.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("comp")).withColumnRenamed("a", "node"))
    while True:
        # the label of a label, until trees are stars
        while True:
            up = labels.select(F.col("node").alias("_n"), F.col("comp").alias("_up"))
            jumped = saved(labels.join(up, labels["comp"] == up["_n"]).select("node", F.col("_up").alias("comp"), (F.col("_up") != F.col("comp")).alias("_moved")))
            labels = jumped.select("node", "comp")
            if jumped.where("_moved").isEmpty():
                break
        left = labels.select(F.col("node").alias("a"), F.col("comp").alias("_ca"))
        right = labels.select(F.col("node").alias("b"), F.col("comp").alias("_cb"))
        across = edges.join(left, "a").join(right, "b").where("_cb < _ca").groupBy("_ca").agg(F.min("_cb").alias("_cb"))
        across = saved(across)
        if across.isEmpty():
            return labels
        hooked = labels.join(across, (labels["node"] == across["_ca"]), "left")
        labels = saved(hooked.select("node", F.coalesce("_cb", "comp").alias("comp")))


def joined(comp: DataFrame, links: DataFrame) -> DataFrame:
    """comp (node, comp) after further links: only the components that they touch are joined anew."""
    root = lambda k: comp.select(F.col("node").alias(k), F.col("comp").alias(f"_c{k}"))
    over = links.join(root("a"), "a", "left").join(root("b"), "b", "left")
    over = saved(over.select("a", "b", F.coalesce("_ca", "a").alias("_ca"), F.coalesce("_cb", "b").alias("_cb")))
    up = components(over.select(F.col("_ca").alias("a"), F.col("_cb").alias("b"))).select(F.col("node").alias("_c"), F.col("comp").alias("_top"))
    ends = over.select(F.col("a").alias("node"), F.col("_ca").alias("comp")).unionByName(over.select(F.col("b").alias("node"), F.col("_cb").alias("comp")))
    all_of = comp.select("node", "comp").unionByName(ends).distinct()
    return saved(all_of.join(up, all_of["comp"] == up["_c"], "left").select("node", F.coalesce("_top", "comp").alias("comp")))
