"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact word length within each source. Whole copies of a source are taken while
they fit its target; what is left is spread over the lengths in proportion, and the last part of it is
filled exactly by a bounded-knapsack dynamic program over (length, count left). Which documents of a length
are taken follows a seeded hash, so reruns agree. Only the counts reach a task of one source, never rows.

Defined results: a null text has size 0, documents of size 0 are never taken, null is a source of its own
(last in order), rows alike in doc_id and text share one decision, an empty table gives an empty result,
and other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import bucket_of, running, saved, spread, table, word_count

#: Words left to the dynamic program, at least, if the budget has as many.
EXACT_TAIL = 4096
#: The dynamic program's budget at most; what choose() leaves to it is below, or no document fits.
BUDGET = 2 * EXACT_TAIL


def fill(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many items of each length (at most counts) make the largest sum not above budget.

    Bounded knapsack: counts are cut in chunks of 1, 2, 4, ... items; each sum remembers the first chunk
    that reached it, and chunks on the way back have falling numbers, so none is used twice."""
    used = np.zeros(len(lengths), np.int64)
    if budget <= 0:
        return used
    reach = np.zeros(budget + 1, bool)
    reach[0] = True
    via = np.full(budget + 1, -1, np.int64)
    chunks: list[tuple[int, int]] = []
    for k in np.argsort(-lengths, kind="stable"):
        length, left, size = int(lengths[k]), int(min(counts[k], budget // max(1, int(lengths[k])))), 1
        while left > 0 and not reach[budget]:
            size = min(size, left)
            step = length * size
            new = np.flatnonzero(reach[: budget + 1 - step] & ~reach[step:]) + step
            reach[new] = True
            via[new] = len(chunks)
            chunks.append((int(k), size))
            left -= size
            size *= 2
    at = int(np.flatnonzero(reach)[-1])
    while at:
        k, size = chunks[via[at]]
        used[k] += size
        at -= int(lengths[k]) * size
    return used


def choose(lengths: np.ndarray, counts: np.ndarray, target: float, seed: int = 0) -> tuple[int, np.ndarray]:
    """Whole copies of every document, and how many documents of each length get one copy more.

    Sums and products are of Python integers, as counts of a large corpus times its words don't fit 64 bits. What the
    proportional part leaves is less than the sum of the distinct lengths; one document more of some lengths, and then
    of ever shorter ones, leaves at most EXACT_TAIL words to the dynamic program, or else only documents too long for it."""
    sizes, left = [int(x) for x in lengths], [int(c) for c in counts]
    total = sum(n * c for n, c in zip(sizes, left, strict=True))
    more = np.zeros(len(lengths), np.int64)
    if not total:
        return 0, more
    copies, rest = divmod(round(target), total)
    more[:] = [c * rest // total for c in left]
    rest -= sum(n * int(m) for n, m in zip(sizes, more, strict=True))
    order = np.random.default_rng(seed).permutation(len(lengths))
    free = [int(k) for k in order if sizes[k] and counts[k] > more[k]]
    for k in [*free, *sorted(free, key=lambda k: -sizes[k])]:
        if counts[k] > more[k] and sizes[k] <= rest - EXACT_TAIL:
            more[k] += 1
            rest -= sizes[k]
    fits = np.flatnonzero((lengths > 0) & (counts > more) & (lengths <= rest))
    if rest > 2 * EXACT_TAIL and len(fits):  # all that is left is longer than rest - EXACT_TAIL
        k = fits[np.argmax(lengths[fits])]
        more[k] += 1
        rest -= sizes[k]
    return copies, more + fill(lengths, counts - more, min(rest, BUDGET))


def targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, source_size -> target: the sources in code point order weigh `weights`, repeating, and share
    `share` of all words; no target is above cap times the source's size, the rest is shared anew by weight.

    Sorted by cap * size / weight, the sources held at their cap are a prefix; the level is the largest of
    (what the prefix leaves) / (weights that remain)."""
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    out = sizes.withColumn("_w", F.get(F.array(*[F.lit(float(w)) for w in weights]), at % len(weights)))
    out = out.withColumn("_ratio", cap * F.col("source_size") / F.col("_w"))
    every, before = Window.partitionBy(F.lit(1)), Window.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = share * F.sum("source_size").over(every) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    weight = F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    out = out.withColumn("_level", left / weight)
    level = F.max("_level").over(every)
    return out.select("source", "source_size", F.least(cap * F.col("source_size"), level * F.col("_w")).cast("double").alias("target"))


def mixture(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 7) -> DataFrame:
    """source, size -> source_size, target, copies (of every such document), cut: documents of this length
    whose hash is not above cut get one copy more. See decided()."""
    narrow = saved(docs.select("source", word_count(F.col("text")).alias("size"), _hash(seed).alias("_u")))
    lengths = narrow.groupBy("source", "size").agg(F.count("*").alias("_n"))
    sizes = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("_n")).alias("source_size"))
    goal = targets(sizes, weights, share, cap)
    both = lengths.join(goal, lengths["source"].eqNullSafe(goal["source"])).drop(goal["source"])

    def fit(one: pd.DataFrame) -> pd.DataFrame:
        one = one.sort_values("size", ignore_index=True)
        copies, more = choose(one["size"].to_numpy(), one["_n"].to_numpy(), float(one["target"].iloc[0]), seed)
        return one.assign(copies=copies, more=np.where(one["size"] > 0, more, 0))

    plan = both.select("source", "size", "_n", "source_size", "target")
    plan = saved(plan.groupBy("source").applyInPandas(fit, f"{plan.schema.simpleString()[7:-1]}, copies bigint, more bigint".replace(":", " ")))

    part = plan.where("more > 0 and more < _n").select(F.col("source").alias("_ps"), F.col("size").alias("_pz"), "_n", "more")
    rows = narrow.join(part, narrow["source"].eqNullSafe(part["_ps"]) & (narrow["size"] == part["_pz"]))
    rows = saved(rows.select("_ps", "_pz", "_u", "more", bucket_of(F.col("_u"), spread(F.col("_n"))).alias("_s")))
    counts = rows.groupBy("_ps", "_pz", "_s", "more").agg(F.count("*").alias("_c"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_c").over(running(["_ps", "_pz"], ["_s"])), F.lit(0)))
    edge = counts.where("_before < more and _before + _c > more").select(F.col("_ps").alias("_es"), F.col("_pz").alias("_ez"), F.col("_s").alias("_eb"), "_before")
    low = counts.where("_before + _c <= more").select("_ps", "_pz", "_s").alias("low")
    # the cut: the largest hash in the buckets taken whole or, ranked, in the bucket on the edge
    upto = F.col("_before") + F.count("*").over(Window.partitionBy("_ps", "_pz", "_s").orderBy("_u"))
    inside = rows.join(edge, rows["_ps"].eqNullSafe(edge["_es"]) & (rows["_pz"] == edge["_ez"]) & (rows["_s"] == edge["_eb"]))
    inside = inside.select("_ps", "_pz", "_u", "more", upto.alias("_upto")).where("_upto <= more").select("_ps", "_pz", "_u")
    whole = low.select(F.col("_ps").alias("_ws"), F.col("_pz").alias("_wz"), F.col("_s").alias("_wb"))
    whole = rows.join(whole, rows["_ps"].eqNullSafe(whole["_ws"]) & (rows["_pz"] == whole["_wz"]) & (rows["_s"] == whole["_wb"])).select("_ps", "_pz", "_u")
    cuts = inside.unionByName(whole).groupBy("_ps", "_pz").agg(F.max("_u").alias("_cut"))
    out = plan.join(cuts, plan["source"].eqNullSafe(cuts["_ps"]) & (plan["size"] == cuts["_pz"]), "left")
    highest, lowest = F.lit((1 << 63) - 1), F.lit(None).cast("long")
    cut = F.when(F.col("more") == F.col("_n"), highest).when(F.col("more") == 0, lowest).otherwise(F.col("_cut"))
    return saved(out.select("source", "size", "source_size", "target", "copies", cut.alias("cut")))


def _hash(seed: int):
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")))


def decided(docs: DataFrame, plan: DataFrame, seed: int = 7) -> DataFrame:
    """docs with size, source_size, target and n_copies (0, 1, 2, ...) in a struct `mix`."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # no column of docs can clash
    rows = docs.select("source", word_count(F.col("text")).alias("_size"), _hash(seed).alias("_u"), whole.alias("_row"))
    plan = plan.select(*[F.col(c).alias(f"_p_{c}") for c in plan.columns])
    out = rows.join(plan, rows["source"].eqNullSafe(plan["_p_source"]) & (rows["_size"] == plan["_p_size"]), "left")
    more = F.coalesce((F.col("_u") <= F.col("_p_cut")).cast("long"), F.lit(0))
    n = F.when(F.col("_size") > 0, F.col("_p_copies") + more).otherwise(F.lit(0))
    mix = F.struct(F.col("_size").alias("size"), F.col("_p_source_size").alias("source_size"), F.col("_p_target").alias("target"), n.cast("long").alias("n_copies"))
    return out.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c != "_mix"], mix.alias("_mix"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it."""
    seed = options.get("seed", 7)
    own = docs.select("doc_id", "source", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    out = decided(own, mixture(docs, **options), seed)
    out = out.select("row", F.explode(F.array_repeat(F.lit(0), F.col("_mix.n_copies").cast("int"))))
    return out.select("row.*")


def op3(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = decided(docs, mixture(docs))
    return out.select("doc_id", "_mix.size", "_mix.source_size", "_mix.target", (F.col("_mix.size") * F.col("_mix.n_copies")).alias("taken"))
