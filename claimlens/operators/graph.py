"""User-vendor edges: anomaly against the slice's other edges, nodes, the shuffled null, and edges as of an order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions import defaults as D
from claimlens.functions.signals import market_key, vertical_key
from claimlens.operators import pit
from claimlens.operators.ranks import quantiles, running
from claimlens.sources.tables import written

SLICE = ["market", "vertical"]
#: What uv_features gives.
FEATURES = ("uv_edge_anomaly", "uv_edge_lift", "uv_edge_n_orders", "uv_edge_elevated", "uv_mo_possible_collusion", "uv_mo_user_scatter", "uv_mo_elevated_uv", "user_bipartite_anomaly", "vendor_bipartite_anomaly")
EDGE = [*SLICE, "user_id", "vendor_id"]


def settled(history: DataFrame) -> DataFrame:
    """Slice keys normalised, one row per order_id (the last by time, then by the larger vendor_id)."""
    rows = history.where("user_id is not null and vendor_id is not null").withColumns({"market": market_key(F.col("market")), "vertical": vertical_key(F.col("vertical")), "is_refund": F.coalesce(F.col("is_refund"), F.lit(0))})
    last = Window.partitionBy("order_id").orderBy(F.col("event_ts").desc(), F.col("vendor_id").desc())
    return rows.withColumn("_k", F.row_number().over(last)).where("_k = 1").drop("_k")


def edge_columns(n: Column, r: Column, others_n: Column, others_r: Column) -> dict[str, Column]:
    """Rate, leave-one-out base, lift, anomaly and the elevated flag (before the null test)."""
    rate = r / F.greatest(n, F.lit(1))
    base = F.greatest(others_r, F.lit(0)) / F.greatest(others_n, F.lit(1))
    lift = rate / F.greatest(base, F.lit(1e-6))
    c = D.EDGES
    up = (n >= c["min_orders"]) & (r >= c["min_refunds"]) & (lift >= c["min_lift"]) & (rate >= c["min_rate"])
    return {"refund_rate": rate, "base_rate": base, "lift": lift, "edge_anomaly": lift * F.log(1 + n) * rate, "elevated": up}


def counts() -> tuple[Column, Column]:
    return F.count("*").alias("n_orders"), F.sum("is_refund").cast("long").alias("n_refunds")


def raw_edges(rows: DataFrame) -> DataFrame:
    return with_anomaly(rows.groupBy(*EDGE).agg(*counts()), rows.groupBy(*SLICE).agg(*counts()))


def with_anomaly(edges: DataFrame, totals: DataFrame) -> DataFrame:
    """Edges (or classes of them: orders and refunds) with edge_columns, given the totals of their slices."""
    total = totals.select(*SLICE, F.col("n_orders").alias("_n"), F.col("n_refunds").alias("_r"))
    # a row a slice
    edges = edges.join(F.broadcast(total), SLICE)
    return edges.withColumns(edge_columns(F.col("n_orders"), F.col("n_refunds"), F.col("_n") - F.col("n_orders"), F.col("_r") - F.col("n_refunds"))).drop("_n", "_r")


def shuffled(here: DataFrame, seed: int) -> DataFrame:
    """Vendors permuted within each slice: the k-th row by order_id gets the vendor of the k-th row by a seeded md5.
    here: settled rows with `_k`, their rank by order_id in the slice."""
    tag = F.md5(F.concat(F.col("order_id").cast("string"), F.lit(f"|{seed}")))
    # hashes spread evenly, so their first digits cut a slice into ranges that needn't be drawn from the rows
    there = here.select(*SLICE, "order_id", "vendor_id", tag.alias("_tag")).withColumn("_range", F.substring("_tag", 1, 3))
    # 4,096 rows a slice at most
    per = there.groupBy(*SLICE, "_range").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*SLICE).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*SLICE, "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_earlier"))
    inside = F.row_number().over(Window.partitionBy(*SLICE, "_range").orderBy("_tag", "order_id"))
    there = there.withColumn("_in", inside).join(F.broadcast(per), [*SLICE, "_range"]).select(*SLICE, "vendor_id", (F.col("_earlier") + F.col("_in")).alias("_k"))
    return here.drop("vendor_id").join(there, [*SLICE, "_k"]).drop("_k")


def null_threshold(rows: DataFrame, shuffles: int | None = None, percentile: float | None = None) -> DataFrame:
    """One row: null_threshold, the percentile of edge anomalies over all shuffles; null if the history is too short.

    A shuffle leaves its slice's totals alone, so an edge's anomaly depends on its own orders and refunds only: shuffled edges
    are counted by them, and the percentile is that of as many rows as such classes."""
    c = D.EDGES
    rows = rows.select(*EDGE, "order_id", "is_refund")
    here = written(running(rows, SLICE, [F.col("order_id")], name="_k"))
    classes = reduce(DataFrame.unionByName, [shuffled(here, s).groupBy(*EDGE).agg(*counts()).groupBy(*SLICE, "n_orders", "n_refunds").agg(F.count("*").alias("_c")) for s in range(shuffles or c["shuffles"])])
    pool = written(with_anomaly(classes.groupBy(*SLICE, "n_orders", "n_refunds").agg(F.sum("_c").alias("_c")), here.groupBy(*SLICE).agg(*counts())))
    cut = quantiles(pool, {"_cut": F.col("edge_anomaly")}, [percentile or c["percentile"]], F.col("_c")).select(F.col("_cut")[0].alias("_cut"))
    size = rows.agg(F.count("*").alias("_size"))
    return cut.crossJoin(size).select(F.when(F.col("_size") >= c["min_history"], F.col("_cut")).alias("null_threshold"))


def _filled(changes: DataFrame, keys: list[str], values: list[str], last: DataFrame) -> DataFrame:
    """changes (keys, _day, values: running sums after the day) -> a row for each day they stand at the start of (`_at`),
    up to the last one. last: one row, `_last`."""
    after = F.lead("_day").over(Window.partitionBy(*keys).orderBy("_day"))
    rows = changes.withColumn("_until", after).crossJoin(F.broadcast(last))
    upto = F.least(F.coalesce("_until", "_last"), F.col("_last"))
    spans = rows.where(F.col("_day") < upto).select(*keys, *values, F.explode(F.sequence(F.col("_day") + 1, upto)).alias("_at"))
    return spans


def null_cut_by_day(rows: DataFrame, shuffles: int | None = None, percentile: float | None = None) -> DataFrame:
    """day, null_threshold: the percentile of shuffled edge anomalies over the history before the day, on every day with
    history before it; null while that is short. rows: settled history.

    Vendors are permuted within slice and day, so that the shuffle of an earlier history is the earlier part of the shuffle.
    An edge's anomaly depends on its slice's totals and on its own orders and refunds alone, so each day is summed up by how
    many shuffled edges of a slice stand at each (orders, refunds): an edge that grows leaves one such class for another.
    The percentile is exact, from days x classes rows, not days x edges."""
    c = D.EDGES
    rows = rows.select(*EDGE, "order_id", "is_refund", F.unix_date(F.to_date("event_ts")).alias("_day"))
    by = [*SLICE, "_day"]
    here = written(running(rows, by, [F.col("order_id")], name="_k"))
    moves = None
    for s in range(shuffles or c["shuffles"]):
        tag = F.md5(F.concat(F.col("order_id").cast("string"), F.lit(f"|{s}")))
        there = running(here.select(*by, "order_id", F.col("vendor_id").alias("_v"), tag.alias("_tag")), by, [F.col("_tag"), F.col("order_id")], name="_k").select(*by, "_v", "_k")
        daily = here.join(there, [*by, "_k"]).groupBy(*SLICE, "user_id", "_v", "_day").agg(F.count("*").alias("_n"), F.sum("is_refund").cast("long").alias("_r"))
        seq = Window.partitionBy(*SLICE, "user_id", "_v").orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        grown = daily.select(*SLICE, "_day", F.sum("_n").over(seq).alias("n"), F.sum("_r").over(seq).alias("r"), "_n", "_r")
        step = F.explode(F.array(F.struct("n", "r", F.lit(1).alias("c")), F.struct((F.col("n") - F.col("_n")).alias("n"), (F.col("r") - F.col("_r")).alias("r"), F.lit(-1).alias("c")))).alias("_x")
        part = grown.select(*SLICE, "_day", step).select(*SLICE, "_day", "_x.*").where("n > 0").groupBy(*SLICE, "n", "r", "_day").agg(F.sum("c").alias("c"))
        moves = part if moves is None else moves.unionByName(part)
    last = rows.agg(F.max("_day").alias("_last"))
    upto = lambda *keys: Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    classes = moves.groupBy(*SLICE, "n", "r", "_day").agg(F.sum("c").alias("c"))
    classes = _filled(classes.withColumn("c", F.sum("c").over(upto(*SLICE, "n", "r"))), [*SLICE, "n", "r"], ["c"], last).where("c > 0")
    total = rows.groupBy(*by).agg(F.count("*").alias("_n"), F.sum("is_refund").cast("long").alias("_r"))
    total = total.select(*by, F.sum("_n").over(upto(*SLICE)).alias("_n"), F.sum("_r").over(upto(*SLICE)).alias("_r"))
    total = written(_filled(total, SLICE, ["_n", "_r"], last))
    scored = classes.join(total, [*SLICE, "_at"]).withColumns(edge_columns(F.col("n"), F.col("r"), F.col("_n") - F.col("n"), F.col("_r") - F.col("r")))
    values = scored.groupBy("_at", "edge_anomaly").agg(F.sum("c").alias("c"))
    # as many rows a day as classes of all slices
    values = values.withColumns({"_upto": F.sum("c").over(Window.partitionBy("_at").orderBy("edge_anomaly")), "_all": F.sum("c").over(Window.partitionBy("_at"))})
    k = F.lit(float(percentile or c["percentile"])) * (F.col("_all") - 1)
    at = lambda i: F.max(F.when((i < F.col("_upto")) & (i >= F.col("_upto") - F.col("c")), F.col("edge_anomaly")))
    cut = values.groupBy("_at").agg(at(F.floor(k)).alias("_low"), at(F.ceil(k)).alias("_high"), F.max(k - F.floor(k)).alias("_part"))
    size = total.groupBy("_at").agg(F.sum("_n").alias("_size"))
    out = cut.join(size, "_at")
    return out.select(F.date_from_unix_date(F.col("_at").cast("int")).alias("day"), F.when(F.col("_size") >= c["min_history"], F.col("_low") + F.col("_part") * (F.col("_high") - F.col("_low"))).alias("null_threshold"))


def with_tags(edges: DataFrame) -> DataFrame:
    """mo_tag of elevated edges by the degrees of both ends over all edges."""
    by_user = edges.groupBy(*SLICE, "user_id").agg(F.count("*").alias("_ud"))
    by_vendor = edges.groupBy(*SLICE, "vendor_id").agg(F.count("*").alias("_vd"))
    out = edges.join(by_user, [*SLICE, "user_id"]).join(by_vendor, [*SLICE, "vendor_id"])
    return out.withColumn("mo_tag", mo_tag(F.col("elevated"), F.col("_ud"), F.col("_vd"))).drop("_ud", "_vd")


def mo_tag(elevated: Column, user_degree: Column, vendor_degree: Column) -> Column:
    return F.when(~elevated, "").when((user_degree <= 2) & (vendor_degree <= 8), "possible_collusion").when(user_degree >= 4, "user_scatter_refunds").otherwise("elevated_uv")


def uv_edges(history: DataFrame, null_test: bool = True) -> DataFrame:
    rows = written(settled(history).select(*EDGE, "order_id", "is_refund"))
    edges = written(raw_edges(rows))
    if null_test:
        cut = null_threshold(rows)
        edges = edges.crossJoin(F.broadcast(cut))
        edges = edges.withColumn("elevated", F.col("elevated") & (F.col("null_threshold").isNull() | (F.col("edge_anomaly") > F.col("null_threshold")))).drop("null_threshold")
    return with_tags(edges)


def uv_nodes(edges: DataFrame) -> DataFrame:
    """Users and vendors of elevated edges; the commonest tag, of several the first in order."""
    ends = F.explode(F.array(*[F.struct(F.lit(k).alias("entity_kind"), F.col(f"{k}_id").cast("string").alias("entity_id")) for k in ("user", "vendor")])).alias("_end")
    key = [*SLICE, "entity_kind", "entity_id"]
    up = edges.where("elevated").select(*SLICE, ends, "n_orders", "n_refunds", "edge_anomaly", "mo_tag").select(*SLICE, "_end.*", "n_orders", "n_refunds", "edge_anomaly", "mo_tag")
    tags = up.groupBy(*key, "mo_tag").agg(F.count("*").alias("_c"), F.sum("n_orders").alias("_n"), F.sum("n_refunds").alias("_r"), F.max("edge_anomaly").alias("_a"))
    best = F.min(F.struct(-F.col("_c"), F.col("mo_tag").alias("tag")))["tag"].alias("mo_tag")
    return tags.groupBy(*key).agg(F.sum("_c").alias("n_partners"), F.sum("_n").alias("n_orders"), F.sum("_r").alias("n_refunds"), F.max("_a").alias("node_anomaly"), F.lit(True).alias("elevated"), best)


def uv_features(orders: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """order_id and nine graph columns looked up in a batch of edges and nodes."""
    at = orders.select("order_id", market_key(F.col("market")).alias("market"), vertical_key(F.col("vertical")).alias("vertical"), "user_id", "vendor_id")
    out = at.join(edges.select(*EDGE, "edge_anomaly", "lift", "n_orders", "elevated", "mo_tag"), EDGE, "left")
    for kind in ("user", "vendor"):
        own = nodes.where(F.col("entity_kind") == kind).select(*SLICE, F.col("entity_id").alias("_e"), F.col("node_anomaly").alias(f"_{kind}"))
        out = out.join(own.withColumnsRenamed({"market": "_m", "vertical": "_v"}), (F.col("market") == F.col("_m")) & (F.col("vertical") == F.col("_v")) & (F.col(f"{kind}_id").cast("string") == F.col("_e")), "left").drop("_m", "_v", "_e")
    tag = lambda t: F.coalesce(F.col("mo_tag") == t, F.lit(False)).cast("double")
    zero = lambda c, v=0.0: F.coalesce(F.col(c).cast("double"), F.lit(v))
    return out.select("order_id", zero("edge_anomaly").alias("uv_edge_anomaly"), zero("lift", 1.0).alias("uv_edge_lift"), zero("n_orders").alias("uv_edge_n_orders"), F.coalesce(F.col("elevated"), F.lit(False)).cast("double").alias("uv_edge_elevated"),
                      tag("possible_collusion").alias("uv_mo_possible_collusion"), tag("user_scatter_refunds").alias("uv_mo_user_scatter"), tag("elevated_uv").alias("uv_mo_elevated_uv"), zero("_user").alias("user_bipartite_anomaly"), zero("_vendor").alias("vendor_bipartite_anomaly"))


def edge_as_of(orders: DataFrame, history: DataFrame, grain: str = "order", null_test: bool = False) -> DataFrame:
    """order_id and the state of the order's edge before it: at its instant without itself ('order'), or at the
    start of its day ('day'). null_test: elevated edges must also exceed the null threshold as of the order's day."""
    # written, so that no later stage holds the sort that settles the history
    rows = written(settled(history.select(*EDGE, "order_id", "is_refund", "cents", "event_ts")))
    at = orders.select("order_id", market_key(F.col("market")).alias("market"), vertical_key(F.col("vertical")).alias("vertical"), "user_id", "vendor_id", F.to_date("event_ts").alias("_day_of"), "event_ts")
    if grain == "day":
        at = at.withColumn("event_ts", F.date_trunc("day", "event_ts") - F.expr("INTERVAL '0.000001' SECOND"))
    # orders carry the sums of their edge on to those of their slice
    out = pit.add_sums(pit.with_own(at, rows, EDGE), rows, {"n_orders": (EDGE, None, "n"), "n_refunds": (EDGE, None, "r")})
    out = pit.add_base(out, rows, SLICE).select("order_id", "_day_of", "n_orders", "n_refunds", "base_n", "base_r")
    out = out.withColumns(edge_columns(F.col("n_orders"), F.col("n_refunds"), F.col("base_n") - F.col("n_orders"), F.col("base_r") - F.col("n_refunds"))).drop("base_n", "base_r")
    if not null_test:
        return out.drop("_day_of")
    # a row a day
    cuts = written(null_cut_by_day(rows))
    out = out.join(cuts, F.col("_day_of") == F.col("day"), "left")
    return out.withColumn("elevated", F.col("elevated") & (F.col("null_threshold").isNull() | (F.col("edge_anomaly") > F.col("null_threshold")))).drop("day", "_day_of")


def elevated_orders(orders: DataFrame, history: DataFrame, mode: str, null_test: bool = False) -> DataFrame:
    """order_id of orders on an elevated edge: mode 'asof_order', 'asof_daily' or 'batch' (which always tests the null)."""
    if mode == "batch":
        at = orders.select("order_id", market_key(F.col("market")).alias("market"), vertical_key(F.col("vertical")).alias("vertical"), "user_id", "vendor_id")
        return at.join(uv_edges(history).where("elevated").select(*EDGE), EDGE, "left_semi").select("order_id")
    return edge_as_of(orders, history, "day" if mode == "asof_daily" else "order", null_test).where("elevated").select("order_id")


def node_table(edges: DataFrame) -> DataFrame:
    """Orders, refunds, partners, mean lift and mean anomaly of each user and vendor over all edges."""
    side = lambda kind: edges.groupBy(*SLICE, F.col(f"{kind}_id").cast("string").alias("entity_id")).agg(F.sum("n_orders").alias("n_orders"), F.sum("n_refunds").alias("n_refunds"), F.count("*").alias("n_partners"), F.avg("lift").alias("mean_lift"), F.avg("edge_anomaly").alias("mean_anomaly")).withColumn("entity_kind", F.lit(kind))
    return side("user").unionByName(side("vendor"))


def export_snapshot(df: DataFrame, path: str, as_of_date: str, version: str, partitions: list[str]) -> None:
    """Write df under as_of_date and further partitions; only the partitions it holds are replaced."""
    out = df.withColumns({"as_of_date": F.lit(as_of_date), "version": F.lit(version)})
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("as_of_date", *partitions).parquet(path)
