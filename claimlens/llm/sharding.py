"""Hilbert-curve sharding with DataFrame functions only.

Metadata dimensions (source, language, size) are quantised to a few bits each and mapped to an index
along a Hilbert curve (Skilling's transpose form). Documents are put in the order of that index and the
order is cut into runs, so each shard covers a compact box of the metadata space and min/max statistics
prune on every dimension at once.

Ranks come from counts, never from one sorted partition: curve cells are counted first, a crowded cell is
split into sub-buckets by text hash and then by row hash, the counts are summed along the curve, and only
the rows of one sub-bucket are sorted together.

Defined results: a null text has no bytes, a null source or language sorts last in its dimension, rows
with equal keys (repeated rows) are interchangeable, an empty table gives an empty result, and columns of
the input that are not asked for are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import bucket_of, byte_length, running, saved, spread, table

BITS = 6


def hilbert_axes(axes: Column, n: int, bits: int) -> Column:
    """Skilling's first pass over an array of n coordinates: undo excess work, from the highest bit down."""
    steps = [(1 << b, i) for b in range(bits - 1, 0, -1) for i in range(n)]
    if not steps:
        return axes
    masks = F.array(*[F.lit(q).cast("long") for q, _ in steps])
    dims = F.array(*[F.lit(i) for _, i in steps])

    def step(x: Column, s: Column) -> Column:
        q, i = F.get(masks, s), F.get(dims, s)
        low, first, own = q - 1, F.get(x, F.lit(0)), F.get(x, i)
        hit = own.bitwiseAND(q) != 0
        swap = F.when(hit, F.lit(0).cast("long")).otherwise(first.bitwiseXOR(own).bitwiseAND(low))
        head = F.when(hit, first.bitwiseXOR(low)).otherwise(first.bitwiseXOR(swap))
        return F.transform(x, lambda v, j: F.when(j == 0, head).when(j == i, v.bitwiseXOR(swap)).otherwise(v))

    return F.aggregate(F.sequence(F.lit(0), F.lit(len(steps) - 1)), axes, step)


def with_hilbert(df: DataFrame, dims: list[Column], bits: int = BITS, name: str = "_cell") -> DataFrame:
    """Add the index of the point (dims, each in [0, 2**bits)) along the Hilbert curve."""
    n = len(dims)
    out = df.withColumn("_ax", hilbert_axes(F.array(*[d.cast("long") for d in dims]), n, bits))
    gray = [F.col("_ax")[0]]
    for i in range(1, n):
        gray.append(gray[-1].bitwiseXOR(F.col("_ax")[i]))
    out = out.withColumn("_gray", F.array(*gray))
    flip = F.lit(0).cast("long")
    for b in range(bits - 1, 0, -1):
        flip = flip.bitwiseXOR(F.when(F.col("_gray")[n - 1].bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1).cast("long")).otherwise(F.lit(0).cast("long")))
    out = out.withColumn("_flip", flip)
    index = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            bit = F.shiftright(F.col("_gray")[i].bitwiseXOR(F.col("_flip")), b).bitwiseAND(F.lit(1).cast("long"))
            index = index + F.shiftleft(bit, b * n + n - 1 - i)
    return out.withColumn(name, index).drop("_ax", "_gray", "_flip")


def ranked_values(df: DataFrame, value: str, bits: int) -> DataFrame:
    """Distinct values of a column in code point order (null last), scaled to [0, 2**bits)."""
    values = df.groupBy(value).agg(F.count("*").alias("_n"))
    at = F.row_number().over(Window.orderBy(F.col(value).asc_nulls_last())) - 1
    count = F.count("*").over(Window.partitionBy(F.lit(1)))
    return values.select(value, F.when(count <= (1 << bits), at).otherwise(F.floor(at * (1 << bits) / count)).cast("long").alias(f"{value}_q"))


def shards(docs: DataFrame, n_shards: int = 24, law: str = "rows", carry: list[str] = (), bits: int = BITS) -> DataFrame:
    """One row per row of docs (columns doc_id, text, lang, source): the carried columns in a struct `row`,
    size, text_crc32, hilbert, shard and slot.

    law 'rows' makes shard counts differ by one at most; law 'bytes' cuts at equal sums of size.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"unknown law: {law}")
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        F.struct(*[F.col(c) for c in (carry or ["doc_id"])]).alias("row"), F.col("doc_id").cast("long").alias("_id"),
        F.col("source").alias("_src"), F.col("lang").alias("_lang"),
        (byte_length(F.col("text")) + 8).alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("_t"), F.xxhash64(F.lit(17), F.col("doc_id"), text).alias("_u"),
    )
    narrow = saved(narrow)
    out = narrow
    for c in ("_src", "_lang"):
        v = ranked_values(narrow, c, bits).withColumnRenamed(c, f"{c}_v")
        out = out.join(v, out[c].eqNullSafe(v[f"{c}_v"]), "left").drop(f"{c}_v")
    quarter_octaves = F.floor(F.log2(F.col("size").cast("double")) * 4 - 12)
    dims = [F.col("_src_q"), F.col("_lang_q"), F.greatest(F.lit(0), F.least(quarter_octaves, F.lit((1 << bits) - 1)))]
    out = saved(with_hilbert(out, dims, bits).drop("_src", "_lang", "_src_q", "_lang_q"))

    cells = out.groupBy("_cell").agg(F.count("*").alias("_c"))
    out = out.join(cells, "_cell").withColumn("_s1", bucket_of(F.col("_t"), spread(F.col("_c"))))
    level1 = out.groupBy("_cell", "_s1").agg(F.count("*").alias("_c1"))
    out = out.join(level1, ["_cell", "_s1"]).withColumn("_s2", bucket_of(F.col("_u"), spread(F.col("_c1"))))

    key = ["_cell", "_s1", "_s2"]
    level2 = out.groupBy(*key).agg(F.count("*").alias("_n"), F.sum("size").alias("_b"))
    zero = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    level2 = level2.withColumns({"_n2": zero("_n", running(key[:2], ["_s2"])), "_b2": zero("_b", running(key[:2], ["_s2"]))})
    mid = level2.groupBy("_cell", "_s1").agg(F.sum("_n").alias("_n"), F.sum("_b").alias("_b"))
    mid = mid.select(*key[:2], zero("_n", running(key[:1], ["_s1"])).alias("_n1"), zero("_b", running(key[:1], ["_s1"])).alias("_b1"), "_n", "_b")
    top = mid.groupBy("_cell").agg(F.sum("_n").alias("_n"), F.sum("_b").alias("_b"))
    every = Window.partitionBy(F.lit(1))
    top = top.select("_cell", zero("_n", running([], ["_cell"])).alias("_n0"), zero("_b", running([], ["_cell"])).alias("_b0"), F.sum("_n").over(every).alias("_total"), F.sum("_b").over(every).alias("_bytes"))
    starts = level2.join(mid.drop("_n", "_b"), key[:2]).join(top, "_cell").select(
        *key, (F.col("_n0") + F.col("_n1") + F.col("_n2")).alias("_before"), (F.col("_b0") + F.col("_b1") + F.col("_b2")).alias("_bytes_before"), "_total", "_bytes")

    local = Window.partitionBy(*key).orderBy("_t", "_u", "_id")
    out = out.join(starts, key)
    rank = F.col("_before") + F.row_number().over(local) - 1
    at = F.col("_bytes_before") + F.coalesce(F.sum("size").over(local.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = out.withColumns({"_rank": rank, "_at": at})
    if law == "rows":
        # exact in integers: the first rank with floor(rank * n / total) = shard is ceil(shard * total / n)
        out = out.withColumn("shard", F.expr(f"cast((_rank * {n_shards}) div _total as int)"))
        first = F.expr(f"(shard * _total + {n_shards - 1}) div {n_shards}")
        out = out.withColumn("slot", (F.col("_rank") - first).cast("long"))
    else:
        out = out.withColumn("shard", F.expr(f"cast(least((_at * {n_shards}) div _bytes, {n_shards - 1}) as int)"))
        out = saved(out)
        firsts = out.groupBy("shard").agg(F.min("_rank").alias("_first"))
        out = out.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("_rank") - F.col("_first"))
    return out.select("row", "size", "text_crc32", F.col("_cell").alias("hilbert"), "shard", "slot")


def op10(spark, sf_dir: str) -> DataFrame:
    law = "rows"
    out = shards(table(spark, sf_dir, "documents"), 24, law)
    return out.select("row.doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")
