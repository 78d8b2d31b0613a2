"""Point-in-time features: what the history showed at the instant of each order, the order itself left out.

Orders and history rows are put in one table; a window over it, keyed by an entity and ordered by time, sums
the history rows up to each order (orders weigh nothing). Windows whose keys begin with the same entity share
one shuffle, and orders carry what they have from one to the next. What the order's own history rows added is
subtracted again. No join on a time range is made.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.sources.tables import written

DAY = 86_400_000_000
MINUTE = 60_000_000
#: Entity windows in days, and the shrinkage of rates.
LINKS = {"ud": ["user_id", "driver_id"], "uv": ["user_id", "vendor_id"], "vd": ["vendor_id", "driver_id"], "uvd": ["user_id", "vendor_id", "driver_id"]}


def shrunk_rate(refunds: Column, orders: Column, base: Column, strength: float = 3.0) -> Column:
    return F.when(orders <= 0, F.lit(0.0)).otherwise((refunds + strength * base) / (orders + strength))


def smoothed_lift(refunds: Column, orders: Column, base: Column, strength: float = 2.0) -> Column:
    return F.when(orders <= 0, F.lit(1.0)).otherwise((refunds + strength * base) / (orders + strength) / base)


def gmv_share(refund: Column, gmv: Column, orders: Column, base: Column) -> Column:
    """Refunded share of money, drawn to the base rate where there are fewer than three orders."""
    thin = (refund + base * gmv * 0.5) / (gmv + 0.5 * gmv)
    return F.when(gmv == 0, F.lit(0.0)).when(orders < 3, thin).otherwise(refund / gmv)


def _micros(df: DataFrame) -> DataFrame:
    return df.withColumn("_t", F.unix_micros("event_ts"))


def timeline(orders: DataFrame, history: DataFrame, keys: list[str], extra: list[str] = ()) -> DataFrame:
    """Orders (weight 0) and history rows (weight 1) with the keys and their time in microseconds."""
    keep = ["order_id", *dict.fromkeys([*keys, *extra])]
    probes = _micros(orders).select(*keep, "_t", F.lit(0).alias("_w"), F.lit(0).cast("long").alias("_r"), F.lit(0).cast("long").alias("_g"))
    return _facts(history, keep).unionByName(probes)


def _facts(history: DataFrame, keep: list[str]) -> DataFrame:
    return _micros(history).select(*keep, "_t", F.lit(1).alias("_w"), F.col("is_refund").cast("long").alias("_r"), F.col("cents").cast("long").alias("_g"))


def upto(keys: list[str], days: int | None = None) -> Window:
    w = Window.partitionBy(*keys).orderBy("_t")
    return w.rangeBetween(Window.unboundedPreceding if days is None else -days * DAY, Window.currentRow)


def with_own(orders: DataFrame, history: DataFrame, keys: list[str]) -> DataFrame:
    """orders with `_t` and `_own`: the order's own rows in the history (keys, time, refund, cents), which sums leave out."""
    own = _facts(history, ["order_id", *keys]).groupBy("order_id").agg(F.collect_list(F.struct(*keys, "_t", "_r", "_g")).alias("_own"))
    return _micros(orders).join(own, "order_id", "left")


def _less(keys: list[str], days: int | None, measure: str) -> Column:
    """What the own rows add to a sum over the keys and days up to `_t`."""
    value = {"n": lambda x: F.lit(1).cast("long"), "r": lambda x: x["_r"], "g": lambda x: x["_g"], "rg": lambda x: x["_r"] * x["_g"]}[measure]

    def inside(x: Column) -> Column:
        same = reduce(lambda a, b: a & b, [x[k] == F.col(k) for k in keys], x["_t"] <= F.col("_t"))
        return same if days is None else same & (x["_t"] >= F.col("_t") - days * DAY)

    part = lambda x: F.when(inside(x), F.coalesce(value(x), F.lit(0))).otherwise(0)
    # most orders have one row of their own, and only lambdas over arrays are interpreted
    several = F.aggregate("_own", F.lit(0).cast("long"), lambda total, x: total + part(x))
    return F.when(F.size("_own") == 1, part(F.get("_own", F.lit(0)))).when(F.size("_own") > 1, several).otherwise(0).cast("long")


def beside(orders: DataFrame, history: DataFrame, keys: list[str]) -> DataFrame:
    """A timeline whose orders (with `_t`) keep all else that they carry in `_row`, null for history rows."""
    others = [c for c in orders.columns if c not in ("order_id", "_t", *keys)]
    row = F.struct(F.lit(True).alias("_there"), *others).alias("_row")
    probes = orders.select("order_id", *keys, "_t", F.lit(0).alias("_w"), F.lit(0).cast("long").alias("_r"), F.lit(0).cast("long").alias("_g"), row)
    return _facts(history, ["order_id", *keys]).unionByName(probes, allowMissingColumns=True)


def orders_of(rows: DataFrame, keys: list[str], *names: str) -> DataFrame:
    """The orders of beside's rows with what they carried and columns that were added."""
    return rows.where("_w = 0").select("order_id", *keys, "_t", "_row.*", *names).drop("_there")


def add_sums(orders: DataFrame, history: DataFrame, wanted: dict[str, tuple[list[str], int | None, str]], more: dict[str, Column] | None = None) -> DataFrame:
    """orders (with_own) and, for each wanted name (keys, days, measure), the sum over the history up to the order.

    Orders go through the windows whole, so no sum is joined to them. Keys of one call should begin with the same entity:
    then one shuffle serves all. Measures: n rows, r refunds, g cents, rg refunded cents. more: further windows, in turn."""
    keys = list(dict.fromkeys(k for ks, _, _ in wanted.values() for k in ks))
    rows = beside(orders, history, keys)
    measures = {"n": F.col("_w"), "r": F.col("_r"), "g": F.col("_g"), "rg": F.col("_r") * F.col("_g")}
    rows = rows.select("*", *[F.sum(measures[m]).over(upto(ks, days)).alias(f"_s_{name}") for name, (ks, days, m) in wanted.items()])
    for name, c in (more or {}).items():
        rows = rows.withColumn(name, c)
    out = orders_of(rows, keys, *[f"_s_{n}" for n in wanted], *(more or {}))
    return out.withColumns({n: (F.col(f"_s_{n}") - _less(*w)).cast("long") for n, w in wanted.items()}).drop(*[f"_s_{n}" for n in wanted])


def window_sums(orders: DataFrame, history: DataFrame, wanted: dict[str, tuple[list[str], int | None, str]]) -> DataFrame:
    """order_id and the sums of add_sums."""
    keys = list(dict.fromkeys(k for ks, _, _ in wanted.values() for k in ks))
    return add_sums(with_own(orders.select("order_id", *keys, "event_ts"), history, keys), history, wanted).select("order_id", *wanted)


def add_base(orders: DataFrame, history: DataFrame, keys: list[str] = ()) -> DataFrame:
    """orders (with_own) and base_n, base_r, base_rate: all history up to the order, or all of the same keys.

    A running total without keys would sort everything in one task, so it is made of the totals of the minutes
    before (1,440 rows a day) and of a running total within the minute."""
    keys = list(keys)
    minute = F.floor(F.col("_t") / MINUTE).alias("_minute")
    minutes = _facts(history, keys).select(*keys, minute, "_w", "_r").unionByName(orders.select(*keys, minute, F.lit(0).alias("_w"), F.lit(0).cast("long").alias("_r")))
    minutes = minutes.groupBy(*keys, "_minute").agg(F.sum("_w").alias("_dn"), F.sum("_r").alias("_dr")).withColumn("_day", F.floor(F.col("_minute") / 1440))
    days = minutes.groupBy(*keys, "_day").agg(F.sum("_dn").alias("_n"), F.sum("_dr").alias("_r"))
    before = lambda c, by, at: F.coalesce(F.sum(c).over(Window.partitionBy(*(by or [F.lit(1)])).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    days = days.select(*keys, "_day", before("_n", keys, "_day").alias("_yn"), before("_r", keys, "_day").alias("_yr"))
    minutes = minutes.withColumns({"_tn": before("_dn", [*keys, "_day"], "_minute"), "_tr": before("_dr", [*keys, "_day"], "_minute")}).join(days, [*keys, "_day"])
    minutes = minutes.select(*keys, "_minute", (F.col("_yn") + F.col("_tn")).alias("_pn"), (F.col("_yr") + F.col("_tr")).alias("_pr"))
    within = Window.partitionBy(*keys, "_minute").orderBy("_t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = beside(orders, history, keys).withColumn("_minute", minute)
    rows = rows.withColumns({"_in": F.sum("_w").over(within), "_ir": F.sum("_r").over(within)})
    out = orders_of(rows, keys, "_minute", "_in", "_ir").join(minutes, [*keys, "_minute"])
    out = out.withColumns({"base_n": (F.col("_pn") + F.col("_in") - _less(keys, None, "n")).cast("long"), "base_r": (F.col("_pr") + F.col("_ir") - _less(keys, None, "r")).cast("long")}).drop("_minute", "_in", "_ir", "_pn", "_pr")
    rate = F.when(F.col("base_n") > 0, F.col("base_r") / F.col("base_n")).otherwise(F.lit(0.05))
    return out.withColumn("base_rate", F.least(F.greatest(rate, F.lit(0.02)), F.lit(0.5)))


def base_rate(orders: DataFrame, history: DataFrame, keys: list[str] = ()) -> DataFrame:
    """order_id, base_n, base_r, base_rate of add_base."""
    return add_base(with_own(orders.select("order_id", *keys, "event_ts"), history, list(keys)), history, keys).select("order_id", "base_n", "base_r", "base_rate")


U, V, DR = ["user_id"], ["vendor_id"], ["driver_id"]
#: Sums keyed by one entity first: one shuffle for the entity and its links.
USER = {"user_n30": (U, 30, "n"), "user_r7": (U, 7, "r"), "user_r30": (U, 30, "r"), "user_g30": (U, 30, "g"), "user_rg30": (U, 30, "rg"),
        "life_n": (U, None, "n"), "life_r": (U, None, "r"), "life_g": (U, None, "g"), "life_rg": (U, None, "rg"),
        **{f"{k}_{m}": (LINKS[k], 90, m) for k in ("ud", "uv", "uvd") for m in "nr"}}
VENDOR = {"vendor_n30": (V, 30, "n"), "vendor_r30": (V, 30, "r"), "vendor_g30": (V, 30, "g"), "vendor_rg30": (V, 30, "rg"), "vd_n": (LINKS["vd"], 90, "n"), "vd_r": (LINKS["vd"], 90, "r")}
DRIVER = {"driver_n30": (DR, 30, "n"), "driver_r30": (DR, 30, "r")}
IDS = ["user_id", "vendor_id", "driver_id"]


def user_windows(orders: DataFrame, history: DataFrame) -> DataFrame:
    return window_sums(orders, history, USER)


def first_seen() -> dict[str, Column]:
    """For add_sums: the user's two earliest events of different orders; one of them isn't the order's own."""
    so_far = Window.partitionBy("user_id").orderBy("_t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    second = F.when((F.col("_w") == 1) & (F.col("order_id") != F.col("_first.order_id")), F.col("_t"))
    return {"_first": F.min(F.when(F.col("_w") == 1, F.struct("_t", "order_id"))).over(so_far), "_second": F.min(second).over(so_far)}


def add_signup(orders: DataFrame, users: DataFrame | None) -> DataFrame:
    """orders (with first_seen) and days since signup: from users, else from the user's first event at that time."""
    if users is not None:
        orders = orders.join(users.groupBy("user_id").agg(F.min(F.unix_micros("signup_ts")).alias("_s")), "user_id", "left")
    else:
        orders = orders.withColumn("_s", F.lit(None).cast("long"))
    first = F.when(F.col("_first.order_id") == F.col("order_id"), F.col("_second")).otherwise(F.col("_first._t"))
    days = (F.col("_t") - F.coalesce(F.col("_s"), first)) / float(DAY)
    return orders.withColumn("user_days_since_signup", F.coalesce(F.greatest(days, F.lit(0.0)), F.lit(0.0))).drop("_first", "_second", "_s")


def signup(orders: DataFrame, history: DataFrame, users: DataFrame | None) -> DataFrame:
    """order_id, days since signup."""
    rows = beside(_micros(orders.select("order_id", "user_id", "event_ts")), history, U)
    for name, c in first_seen().items():
        rows = rows.withColumn(name, c)
    return add_signup(orders_of(rows, U, "_first", "_second"), users).select("order_id", "user_days_since_signup")


def per_device(devices: DataFrame) -> DataFrame:
    """device_id, its accounts and those of its cluster, which is its smallest cluster_id."""
    out = devices.groupBy("device_id").agg(F.count_distinct("user_id").alias("_a"), F.min("cluster_id").alias("cluster_id"))
    per_cluster = devices.groupBy("cluster_id").agg(F.count_distinct("user_id").alias("_c"))
    return out.join(per_cluster, "cluster_id", "left").drop("cluster_id")


def device_columns() -> dict[str, Column]:
    """From per_device's columns and `_d`, the user's devices."""
    one = lambda *cs: F.greatest(F.coalesce(*cs, F.lit(1)), F.lit(1)).cast("double")
    return {"accounts_per_device": one("_a"), "devices_per_account": one("_d"), "device_cluster_size": one("_c", "_a"), "device_churn_30d": F.coalesce("_d", F.lit(0)).cast("double")}


def device_stats(orders: DataFrame, devices: DataFrame) -> DataFrame:
    """order_id, accounts per device, devices per account, cluster size and churn, from the whole device table."""
    per_user = devices.groupBy("user_id").agg(F.count_distinct("device_id").alias("_d"))
    out = orders.select("order_id", "user_id", "device_id").join(per_device(devices), "device_id", "left").join(per_user, "user_id", "left")
    return out.select("order_id", *[c.alias(n) for n, c in device_columns().items()])


FLAGS = ("is_emulator", "is_cloned_app", "is_gps_spoof", "is_tampered")


def number(df: DataFrame, name: str, default: float = 0.0) -> Column:
    """A column as double; missing, null, NaN and what isn't a number count as the default."""
    if name not in df.columns:
        return F.lit(default)
    c = F.col(name).try_cast("double")
    return F.when(c.isNull() | F.isnan(c), F.lit(default)).otherwise(c)


def _clamp(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(100.0))


def integrity(orders: DataFrame) -> dict[str, Column]:
    """What the orders themselves hold of risk score and flags."""
    return {"_orisk": _clamp(number(orders, "device_risk_score")), **{f"_o_{f}": number(orders, f) for f in FLAGS}}


def add_integrity(orders: DataFrame) -> DataFrame:
    """device_risk_score and flags from integrity's columns and those of device_table."""
    risk, own = F.coalesce(_clamp(F.col("_risk")), F.lit(0.0)), F.col("_orisk")
    cols = {f: ((F.coalesce(F.col(f"_{f}"), F.lit(0.0)) >= 1) | (F.col(f"_o_{f}") >= 1)).cast("double") for f in FLAGS}
    cols["device_risk_score"] = F.when((risk <= 0) & (own > 0), own).otherwise(risk)
    return orders.withColumns(cols).drop("_orisk", "_risk", *[f"_{f}" for f in FLAGS], *[f"_o_{f}" for f in FLAGS])


def device_table(devices: DataFrame) -> DataFrame:
    """device_id, risk score and flags of the row of the smallest user_id."""
    first = devices.withColumn("_k", F.row_number().over(Window.partitionBy("device_id").orderBy("user_id"))).where("_k = 1")
    return first.select("device_id", number(devices, "device_risk_score").alias("_risk"), *[number(devices, f).alias(f"_{f}") for f in FLAGS])


def device_integrity(orders: DataFrame, devices: DataFrame) -> DataFrame:
    """order_id, risk score and flags: the device table first (the row of the smallest user_id), the order where that has none."""
    out = add_integrity(orders.select("order_id", "device_id", *[c.alias(n) for n, c in integrity(orders).items()]).join(device_table(devices), "device_id", "left"))
    return out.select("order_id", "device_risk_score", *FLAGS)


def claim_delivery(orders: DataFrame) -> dict[str, Column]:
    """Seven clamped claim and delivery columns."""
    names = ("customer_courier_same_device", "claim_has_image", "claim_in_app_capture", "pin_required", "pin_verified", "delivery_geofence_ok")
    out = {n: (number(orders, n) >= 1).cast("double") for n in names}
    return out | {"claim_image_ai_risk": F.least(F.greatest(number(orders, "claim_image_ai_risk"), F.lit(0.0)), F.lit(1.0))}


def order_flags() -> dict[str, Column]:
    vertical, reason, status = (F.lower(F.coalesce(F.col(c), F.lit(""))) for c in ("vertical", "claim_reason", "status"))
    as_double = lambda b: b.cast("double")
    return {
        "is_food": as_double(vertical == "food"), "is_qcommerce": as_double(vertical.isin("qcommerce", "q_commerce", "quick_commerce")),
        "claim_reason_missing_item": as_double(reason.contains("missing")), "claim_reason_quality": as_double(reason.contains("quality") | reason.contains("spoil")),
        "claim_reason_wrong_order": as_double(reason.contains("wrong")), "order_status_delivered": as_double(status == "delivered"),
    }


def reason_kind() -> Column:
    reason = F.lower(F.coalesce(F.trim("claim_reason"), F.lit("")))
    return F.when((reason == "") | (reason == "nan"), "unknown").otherwise(reason)


def reason_rates(orders: DataFrame, facts: DataFrame, days: int = 30) -> DataFrame:
    """order_id, reason_repeat_rate_30d of orders (with_own) whose user has refunds. facts: history with `reason`."""
    facts = facts.where("is_refund = 1")
    asked = orders.select("order_id", "user_id", "_t", "_own").join(facts.select("user_id", "reason").distinct(), "user_id")
    # every fact here is a refund, so r counts them
    sums = add_sums(asked, facts, {"_n": (["user_id", "reason"], days, "r")})
    share = F.when(F.sum("_n") < 2, F.lit(0.0)).otherwise(F.max("_n") / F.sum("_n"))
    return sums.groupBy("order_id").agg(share.alias("reason_repeat_rate_30d"))


def reason_repeat(orders: DataFrame, history: DataFrame, days: int = 30) -> DataFrame:
    """order_id, share of the commonest claim reason among the user's refunds, 0 with fewer than two.

    Each order is asked about each reason its user ever had: reasons are few."""
    facts = history.withColumn("reason", reason_kind())
    got = reason_rates(with_own(orders.select("order_id", "user_id", "event_ts"), facts, ["user_id", "reason"]), facts, days)
    out = orders.select("order_id").join(got, "order_id", "left")
    return out.select("order_id", F.coalesce("reason_repeat_rate_30d", F.lit(0.0)).alias("reason_repeat_rate_30d"))


def _peers(at: DataFrame, history: DataFrame, devices: DataFrame, *keep: str) -> DataFrame:
    """A row per order (with `_t`) and peer, with what else of the order is to be kept."""
    pairs = devices.select("device_id", F.col("user_id").alias("peer")).distinct()
    cluster = devices.groupBy("device_id").agg(F.min("cluster_id").alias("cluster_id"))
    members = devices.where("cluster_id is not null").select("cluster_id", F.col("user_id").alias("peer")).distinct()
    # a device's peers, itself and its cluster's, before orders meet them: one join of orders
    near = pairs.unionByName(cluster.join(members, "cluster_id").select("device_id", "peer")).distinct()
    seen = _micros(history).groupBy("vendor_id", "driver_id", F.col("user_id").alias("peer")).agg(F.min("_t").alias("_first"))
    by_device = at.select("order_id", "user_id", "device_id", *keep).join(near, "device_id").select("order_id", "user_id", "peer", *keep)
    by_ring = at.select(*dict.fromkeys(["order_id", "user_id", "vendor_id", "driver_id", "_t", *keep])).join(seen, ["vendor_id", "driver_id"]).where("_first <= _t").select("order_id", "user_id", "peer", *keep)
    return by_device.unionByName(by_ring).where("peer <> user_id").drop("user_id").dropDuplicates(["order_id", "peer"])


def related_accounts(orders: DataFrame, history: DataFrame, devices: DataFrame) -> DataFrame:
    """order_id, peer: users of the same device or device cluster, and users seen up to then with the same
    driver and vendor; without the user."""
    return _peers(_micros(orders), history, devices)


def related_sums(orders: DataFrame, history: DataFrame, devices: DataFrame) -> DataFrame:
    """related_stats of the orders (with_own, and add_base) that have peers."""
    at = orders.where("base_n > 0").withColumn("_own", F.filter("_own", lambda x: x["user_id"] != F.col("user_id")))
    peers = _peers(at, history, devices, "_t", "_own", "base_rate").withColumnRenamed("peer", "user_id")
    sums = add_sums(peers, history, {"_n": (U, 30, "n"), "_c": (U, 30, "r"), "_rg": (U, 30, "rg")})
    return sums.groupBy("order_id").agg(
        F.count("*").cast("double").alias("related_account_count"), F.sum("_c").cast("double").alias("related_refund_count_30d"), F.sum("_rg").alias("related_refund_cents_30d"),
        F.max(shrunk_rate(F.col("_c"), F.col("_n"), F.col("base_rate"))).alias("related_max_refund_rate_30d"), F.max("_n").cast("double").alias("related_max_orders_30d"))


def related_stats(orders: DataFrame, history: DataFrame, devices: DataFrame) -> DataFrame:
    """What the related accounts did in the 30 days before. Peers are looked up in running sums, not in the
    history itself: the rows are as many as peers."""
    got = related_sums(add_base(with_own(orders.select("order_id", *IDS, "device_id", "event_ts"), history, U), history), history, devices)
    return filled(orders.select("order_id").join(got, "order_id", "left"), got)


def filled(out: DataFrame, got: DataFrame) -> DataFrame:
    """out with 0 for nulls in got's columns."""
    return out.withColumns({c: F.coalesce(c, F.lit(0)).cast(t) for c, t in got.dtypes if c != "order_id"})


def link_columns() -> dict[str, Column]:
    """How often pairs and triples were seen, their lift and their share of the user's refunds, from USER's and VENDOR's sums."""
    cols: dict[str, Column] = {}
    for k in LINKS:
        share = F.when(F.col("user_r30") > 0, F.least(F.col(f"{k}_r") / F.col("user_r30"), F.lit(1.0))).otherwise(F.lit(0.0))
        cols |= {f"{k}_cooccur": F.col(f"{k}_n").cast("double"), f"{k}_refund_lift": smoothed_lift(F.col(f"{k}_r"), F.col(f"{k}_n"), F.col("base_rate")), f"{k}_refund_share": F.when(F.col(f"{k}_n") > 0, share).otherwise(F.lit(0.0))}
    return cols


def entity_columns(entities: tuple[str, ...]) -> dict[str, Column]:
    """Orders, refunds, refund rate and (but for drivers) refunded share of money in 30 days."""
    b, cols = F.col("base_rate"), {}
    for e in entities:
        cols |= {f"{e}_orders_30d": F.col(f"{e}_n30").cast("double"), f"{e}_refund_count_30d": F.col(f"{e}_r30").cast("double"), f"{e}_refund_rate_30d": shrunk_rate(F.col(f"{e}_r30"), F.col(f"{e}_n30"), b)}
    for e in entities:
        if e != "driver":
            cols[f"{e}_refund_gmv_pct_30d"] = gmv_share(F.col(f"{e}_rg30"), F.col(f"{e}_g30"), F.col(f"{e}_n30"), b)
    return cols


def based(orders: DataFrame, history: DataFrame) -> DataFrame:
    """order_id, ids, own rows and the base rate: what sums by entity begin with."""
    return add_base(with_own(orders.select("order_id", *IDS, "event_ts"), history, IDS), history)


def driver_vendor_features(orders: DataFrame, history: DataFrame) -> DataFrame:
    return add_sums(add_sums(based(orders, history), history, VENDOR), history, DRIVER).withColumns(entity_columns(("driver", "vendor")))


def link_features(orders: DataFrame, history: DataFrame) -> DataFrame:
    wanted = {n: w for n, w in USER.items() if n == "user_r30" or n[:2] in LINKS or n[:3] in LINKS}
    vendor = {n: w for n, w in VENDOR.items() if n[:2] in LINKS}
    return add_sums(add_sums(based(orders, history), history, wanted), history, vendor).withColumns(link_columns())


def order_features(orders: DataFrame, history: DataFrame, devices: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """One row per order with all entity, link, device, related, platform and flag features (money in cents).

    The sums of all entities come in one narrow row; only what has rows of its own for each reason or peer, and the
    order's own columns, are joined to it."""
    keep = [c for c in ("user_id", "driver_id", "vendor_id", "device_id", "market", "vertical", "status", "claim_reason", "event_ts", "cents", "is_refund") if c in orders.columns]
    flags = order_flags() | claim_delivery(orders)
    history = history.withColumn("reason", reason_kind())
    o = written(add_base(with_own(orders.select("order_id", *IDS, "device_id", "event_ts"), history, [*IDS, "reason"]), history))
    reasons, related = reason_rates(o, history), related_sums(o, history, devices)
    sums = add_signup(add_sums(o.drop("event_ts", "device_id"), history, USER, first_seen()), users)
    sums = sums.join(devices.groupBy("user_id").agg(F.count_distinct("device_id").alias("_d")), "user_id", "left")
    sums = add_sums(add_sums(sums, history, VENDOR), history, DRIVER).drop("_own", "_t", *IDS)
    # what doesn't depend on time, by the order's device
    out = orders.select("order_id", *keep, *[c.alias(n) for n, c in (flags | integrity(orders)).items()])
    out = add_integrity(out.join(per_device(devices).join(device_table(devices), "device_id"), "device_id", "left")).join(sums, "order_id").withColumns(device_columns())
    out = filled(filled(out.join(reasons, "order_id", "left").join(related, "order_id", "left"), reasons), related)
    entity, real = entity_columns(("user", "driver", "vendor")), lambda c: F.col(c).cast("double")
    ratio = F.when(F.col("life_g") > 0, F.col("life_rg") / F.col("life_g")).otherwise(F.lit(0.0))
    cols = entity | link_columns()
    cols |= {"user_refund_count_7d": real("user_r7"), "user_lifetime_orders": real("life_n"), "user_lifetime_refund_count": real("life_r"), "user_lifetime_cents": F.col("life_g"), "user_lifetime_refund_cents": F.col("life_rg"),
             "user_ltv_net_cents": F.col("life_g") - F.col("life_rg"), "user_refund_to_ltv_ratio": ratio, "combined_refund_count_30d": F.col("user_r30") + F.col("related_refund_count_30d"), "combined_refund_cents_30d": F.col("user_rg30") + F.col("related_refund_cents_30d")}
    first = ["order_id", *keep, "base_n", "base_r", "base_rate", "user_days_since_signup", *device_columns(), "device_risk_score", *FLAGS, "reason_repeat_rate_30d", *[c for c in related.columns if c != "order_id"], *flags]
    return out.select(*first, *[c.alias(n) for n, c in cols.items()])
