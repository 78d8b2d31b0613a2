"""Queries of the point-in-time features and their DuckDB twins (plain joins on time ranges)."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens.operators import pit
from claimlens.sources.views import view, with_views


def tables(spark, sf_dir):
    return [view(spark, sf_dir, n) for n in ("ord", "hist", "dev", "usr")]


def features(spark, sf_dir):
    return pit.order_features(*tables(spark, sf_dir))


def rounded(df, *names, digits=6):
    return df.withColumns({n: F.round(n, digits) for n in names})


# DuckDB: the history of each order, itself left out, and all features over it.
PAST = """past AS (
SELECT o.order_id, o.user_id AS ou, o.driver_id AS od, o.vendor_id AS ov, o.event_ts AS ots, h.user_id, h.driver_id, h.vendor_id, h.cents, h.is_refund, h.event_ts,
       CASE WHEN lower(trim(h.claim_reason)) IN ('', 'nan') THEN 'unknown' ELSE lower(trim(h.claim_reason)) END AS reason, h.order_id AS hid,
       h.event_ts >= o.event_ts - INTERVAL '30' DAY AS d30, h.event_ts >= o.event_ts - INTERVAL '7' DAY AS d7, h.event_ts >= o.event_ts - INTERVAL '90' DAY AS d90
FROM ord o JOIN hist h ON h.event_ts <= o.event_ts AND h.order_id <> o.order_id)"""
BASE = """base AS (
SELECT o.order_id, count(p.hid) AS base_n, coalesce(sum(p.is_refund), 0) AS base_r,
       least(greatest(CASE WHEN count(p.hid) > 0 THEN sum(p.is_refund) / count(p.hid) ELSE 0.05 END, 0.02), 0.5) AS base_rate
FROM ord o LEFT JOIN past p ON p.order_id = o.order_id GROUP BY o.order_id)"""
SUMS = """sums AS (
SELECT o.order_id,
""" + ",\n".join(
    f"coalesce(sum(CASE WHEN {cond} THEN {value} END), 0) AS {name}"
    for name, cond, value in [
        *[(f"user_{m}", f"p.user_id = ou AND {d}", v) for m, d, v in (("n30", "d30", "1"), ("r7", "d7", "p.is_refund"), ("r30", "d30", "p.is_refund"), ("g30", "d30", "p.cents"), ("rg30", "d30", "p.cents * p.is_refund"))],
        *[(f"life_{m}", "p.user_id = ou", v) for m, v in (("n", "1"), ("r", "p.is_refund"), ("g", "p.cents"), ("rg", "p.cents * p.is_refund"))],
        *[(f"vendor_{m}", "p.vendor_id = ov AND d30", v) for m, v in (("n30", "1"), ("r30", "p.is_refund"), ("g30", "p.cents"), ("rg30", "p.cents * p.is_refund"))],
        *[(f"driver_{m}", "p.driver_id = od AND d30", v) for m, v in (("n30", "1"), ("r30", "p.is_refund"))],
        *[(f"{k}_{m}", f"{c} AND d90", v) for k, c in (("ud", "p.user_id = ou AND p.driver_id = od"), ("uv", "p.user_id = ou AND p.vendor_id = ov"), ("vd", "p.vendor_id = ov AND p.driver_id = od"), ("uvd", "p.user_id = ou AND p.vendor_id = ov AND p.driver_id = od")) for m, v in (("n", "1"), ("r", "p.is_refund"))],
    ]
) + "\nFROM ord o LEFT JOIN past p ON p.order_id = o.order_id GROUP BY o.order_id)"
SIGNUP = """signup AS (
SELECT o.order_id, coalesce(greatest((epoch_us(o.event_ts) - epoch_us(coalesce(u.signup_ts, f.first_ts))) / 86400000000.0, 0), 0) AS user_days_since_signup
FROM ord o LEFT JOIN usr u ON u.user_id = o.user_id
LEFT JOIN (SELECT order_id, min(event_ts) AS first_ts FROM past WHERE user_id = ou GROUP BY order_id) f ON f.order_id = o.order_id)"""
DEVICE = """devs AS (
SELECT o.order_id, CAST(greatest(coalesce(a.n, 1), 1) AS DOUBLE) AS accounts_per_device, CAST(greatest(coalesce(d.n, 1), 1) AS DOUBLE) AS devices_per_account,
       CAST(greatest(coalesce(c.n, a.n, 1), 1) AS DOUBLE) AS device_cluster_size, CAST(coalesce(d.n, 0) AS DOUBLE) AS device_churn_30d
FROM ord o LEFT JOIN (SELECT device_id, count(DISTINCT user_id) AS n, min(cluster_id) AS cluster_id FROM dev GROUP BY 1) a ON a.device_id = o.device_id
LEFT JOIN (SELECT user_id, count(DISTINCT device_id) AS n FROM dev GROUP BY 1) d ON d.user_id = o.user_id
LEFT JOIN (SELECT cluster_id, count(DISTINCT user_id) AS n FROM dev GROUP BY 1) c ON c.cluster_id = a.cluster_id)"""
INTEGRITY = """integrity AS (
SELECT o.order_id, coalesce(d.device_risk_score, 0.0) AS device_risk_score, CAST(coalesce(d.is_emulator, 0) AS DOUBLE) AS is_emulator, CAST(coalesce(d.is_cloned_app, 0) AS DOUBLE) AS is_cloned_app,
       CAST(coalesce(d.is_gps_spoof, 0) AS DOUBLE) AS is_gps_spoof, CAST(coalesce(d.is_tampered, 0) AS DOUBLE) AS is_tampered
FROM ord o LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY user_id) AS r FROM dev) d ON d.device_id = o.device_id AND d.r = 1)"""
REASON = """reasons AS (
SELECT o.order_id, coalesce(x.rate, 0.0) AS reason_repeat_rate_30d FROM ord o
LEFT JOIN (SELECT order_id, CASE WHEN sum(n) < 2 THEN 0.0 ELSE max(n) / sum(n) END AS rate
           FROM (SELECT order_id, reason, count(*) AS n FROM past WHERE user_id = ou AND d30 AND is_refund = 1 GROUP BY 1, 2) GROUP BY 1) x ON x.order_id = o.order_id)"""
RELATED = """clusters AS (SELECT device_id, min(cluster_id) AS cluster_id FROM dev GROUP BY 1),
peers AS (
SELECT DISTINCT order_id, peer FROM (
  SELECT o.order_id, o.user_id, d.user_id AS peer FROM ord o JOIN dev d ON d.device_id = o.device_id
  UNION ALL SELECT o.order_id, o.user_id, m.user_id FROM ord o JOIN clusters c ON c.device_id = o.device_id JOIN dev m ON m.cluster_id = c.cluster_id
  UNION ALL SELECT order_id, ou, user_id FROM past WHERE vendor_id = ov AND driver_id = od) WHERE peer <> user_id),
peer_sums AS (
SELECT q.order_id, q.peer, count(p.hid) AS n, coalesce(sum(p.is_refund), 0) AS r, coalesce(sum(p.is_refund * p.cents), 0) AS rg
FROM peers q LEFT JOIN past p ON p.order_id = q.order_id AND p.user_id = q.peer AND p.d30 GROUP BY 1, 2),
related AS (
SELECT o.order_id, CAST(count(s.peer) AS DOUBLE) AS related_account_count, CAST(coalesce(sum(s.r), 0) AS DOUBLE) AS related_refund_count_30d, CAST(coalesce(sum(s.rg), 0) AS BIGINT) AS related_refund_cents_30d,
       coalesce(max(CASE WHEN s.n <= 0 THEN 0.0 ELSE (s.r + 3.0 * b.base_rate) / (s.n + 3.0) END), 0.0) AS related_max_refund_rate_30d, CAST(coalesce(max(s.n), 0) AS DOUBLE) AS related_max_orders_30d
FROM ord o JOIN base b ON b.order_id = o.order_id LEFT JOIN peer_sums s ON s.order_id = o.order_id AND b.base_n > 0 GROUP BY 1)"""


def _rate(e):
    return f"CASE WHEN s.{e}_n30 <= 0 THEN 0.0 ELSE (s.{e}_r30 + 3.0 * b.base_rate) / (s.{e}_n30 + 3.0) END"


def _gmv(e):
    return f"CASE WHEN s.{e}_g30 = 0 THEN 0.0 WHEN s.{e}_n30 < 3 THEN (s.{e}_rg30 + b.base_rate * s.{e}_g30 * 0.5) / (s.{e}_g30 + 0.5 * s.{e}_g30) ELSE s.{e}_rg30 / s.{e}_g30 END"


def _link(k):
    return f"""CAST(s.{k}_n AS DOUBLE) AS {k}_cooccur, CASE WHEN s.{k}_n <= 0 THEN 1.0 ELSE (s.{k}_r + 2.0 * b.base_rate) / (s.{k}_n + 2.0) / b.base_rate END AS {k}_refund_lift,
       CASE WHEN s.{k}_n > 0 AND s.user_r30 > 0 THEN least(s.{k}_r / s.user_r30, 1.0) ELSE 0.0 END AS {k}_refund_share"""


FEAT = f"""feat AS (
SELECT o.order_id, o.user_id, o.driver_id, o.vendor_id, o.device_id, o.market, o.vertical, o.status, o.claim_reason, o.event_ts, o.cents, o.is_refund, b.base_n, b.base_r, b.base_rate,
       {", ".join(f"CAST(s.{e}_n30 AS DOUBLE) AS {e}_orders_30d, CAST(s.{e}_r30 AS DOUBLE) AS {e}_refund_count_30d, {_rate(e)} AS {e}_refund_rate_30d" for e in ("user", "driver", "vendor"))},
       {_gmv("user")} AS user_refund_gmv_pct_30d, {_gmv("vendor")} AS vendor_refund_gmv_pct_30d,
       {", ".join(_link(k) for k in ("ud", "uv", "vd", "uvd"))},
       CAST(s.user_r7 AS DOUBLE) AS user_refund_count_7d, CAST(s.life_n AS DOUBLE) AS user_lifetime_orders, CAST(s.life_r AS DOUBLE) AS user_lifetime_refund_count,
       s.life_g AS user_lifetime_cents, s.life_rg AS user_lifetime_refund_cents, s.life_g - s.life_rg AS user_ltv_net_cents,
       CASE WHEN s.life_g > 0 THEN s.life_rg / s.life_g ELSE 0.0 END AS user_refund_to_ltv_ratio, g.user_days_since_signup,
       d.accounts_per_device, d.devices_per_account, d.device_cluster_size, d.device_churn_30d,
       i.device_risk_score, i.is_emulator, i.is_cloned_app, i.is_gps_spoof, i.is_tampered, x.reason_repeat_rate_30d,
       r.related_account_count, r.related_refund_count_30d, r.related_refund_cents_30d, r.related_max_refund_rate_30d, r.related_max_orders_30d,
       s.user_r30 + r.related_refund_count_30d AS combined_refund_count_30d, CAST(s.user_rg30 + r.related_refund_cents_30d AS BIGINT) AS combined_refund_cents_30d,
       CASE WHEN o.vertical = 'food' THEN 1.0 ELSE 0.0 END AS is_food, CASE WHEN o.vertical = 'qcommerce' THEN 1.0 ELSE 0.0 END AS is_qcommerce,
       CASE WHEN contains(o.claim_reason, 'missing') THEN 1.0 ELSE 0.0 END AS claim_reason_missing_item, CASE WHEN contains(o.claim_reason, 'quality') THEN 1.0 ELSE 0.0 END AS claim_reason_quality,
       CASE WHEN contains(o.claim_reason, 'wrong') THEN 1.0 ELSE 0.0 END AS claim_reason_wrong_order, CASE WHEN o.status = 'delivered' THEN 1.0 ELSE 0.0 END AS order_status_delivered,
       0.0 AS customer_courier_same_device, 0.0 AS claim_has_image, 0.0 AS claim_in_app_capture, 0.0 AS pin_required, 0.0 AS pin_verified, 0.0 AS delivery_geofence_ok, 0.0 AS claim_image_ai_risk
FROM ord o JOIN base b ON b.order_id = o.order_id JOIN sums s ON s.order_id = o.order_id JOIN signup g ON g.order_id = o.order_id JOIN devs d ON d.order_id = o.order_id
JOIN integrity i ON i.order_id = o.order_id JOIN reasons x ON x.order_id = o.order_id JOIN related r ON r.order_id = o.order_id)"""
#: All parts that lead to feat, for other queries to build on.
FEATURE_PARTS = (PAST, BASE, SUMS, SIGNUP, DEVICE, INTEGRITY, REASON, RELATED, FEAT)
VIEWS = "ord dev usr"

GROUPS = {
    "pit_user_features": ["user_orders_30d", "user_refund_count_7d", "user_refund_count_30d", "user_refund_rate_30d", "user_refund_gmv_pct_30d", "user_lifetime_orders", "user_lifetime_refund_count", "user_lifetime_cents", "user_lifetime_refund_cents", "user_ltv_net_cents", "user_refund_to_ltv_ratio", "user_days_since_signup"],
    "pit_driver_vendor_features": ["driver_orders_30d", "driver_refund_count_30d", "driver_refund_rate_30d", "vendor_orders_30d", "vendor_refund_count_30d", "vendor_refund_rate_30d", "vendor_refund_gmv_pct_30d"],
    "pit_link_features": [f"{k}_{m}" for k in ("ud", "uv", "vd", "uvd") for m in ("cooccur", "refund_lift", "refund_share")],
    "pit_base_rate": ["base_n", "base_r", "base_rate"],
    "device_features": ["accounts_per_device", "devices_per_account", "device_cluster_size", "device_churn_30d"],
    "device_integrity": ["device_risk_score", "is_emulator", "is_cloned_app", "is_gps_spoof", "is_tampered"],
    "reason_repeat": ["reason_repeat_rate_30d"],
    "related_features": ["related_account_count", "related_refund_count_30d", "related_refund_cents_30d", "related_max_refund_rate_30d", "related_max_orders_30d"],
    "order_flags": ["is_food", "is_qcommerce", "claim_reason_missing_item", "claim_reason_quality", "claim_reason_wrong_order", "order_status_delivered"],
}
INTS = {"base_n", "base_r", "user_lifetime_cents", "user_lifetime_refund_cents", "user_ltv_net_cents", "related_refund_cents_30d", "combined_refund_cents_30d"}


def _spark(cols):
    return [F.col(c).cast("long") if c in INTS else F.round(F.col(c).cast("double"), 6).alias(c) for c in cols]


def _sql(cols):
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" if c in INTS else f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in cols)


def _only(build, cols):
    return lambda spark, sf: build(*tables(spark, sf)).select("order_id", *_spark(cols))


def _user(o, h, d, u):
    s = pit.add_signup(pit.add_sums(pit.based(o, h), h, {n: w for n, w in pit.USER.items() if n[:4] in ("user", "life")}, pit.first_seen()), u)
    real = lambda a, b: F.col(a).cast("double").alias(b)
    return s.select("order_id", real("user_n30", "user_orders_30d"), real("user_r7", "user_refund_count_7d"), real("user_r30", "user_refund_count_30d"), pit.shrunk_rate(F.col("user_r30"), F.col("user_n30"), F.col("base_rate")).alias("user_refund_rate_30d"),
                    pit.gmv_share(F.col("user_rg30"), F.col("user_g30"), F.col("user_n30"), F.col("base_rate")).alias("user_refund_gmv_pct_30d"), real("life_n", "user_lifetime_orders"), real("life_r", "user_lifetime_refund_count"),
                    F.col("life_g").alias("user_lifetime_cents"), F.col("life_rg").alias("user_lifetime_refund_cents"), (F.col("life_g") - F.col("life_rg")).alias("user_ltv_net_cents"),
                    F.when(F.col("life_g") > 0, F.col("life_rg") / F.col("life_g")).otherwise(F.lit(0.0)).alias("user_refund_to_ltv_ratio"), "user_days_since_signup")


BUILD = {
    "pit_user_features": _user,
    "pit_base_rate": lambda o, h, d, u: pit.base_rate(o, h),
    "device_features": lambda o, h, d, u: pit.device_stats(o, d),
    "device_integrity": lambda o, h, d, u: pit.device_integrity(o, d),
    "reason_repeat": lambda o, h, d, u: pit.reason_repeat(o, h),
    "related_features": lambda o, h, d, u: pit.related_stats(o, h, d),
    "pit_driver_vendor_features": lambda o, h, d, u: pit.driver_vendor_features(o, h),
    "pit_link_features": lambda o, h, d, u: pit.link_features(o, h),
    "order_flags": lambda o, h, d, u: o.select("order_id", *[c.alias(n) for n, c in pit.order_flags().items()]),
}


def queries():
    out = {name: _only(BUILD.get(name, pit.order_features), cols) for name, cols in GROUPS.items()}
    every = [c for cols in GROUPS.values() for c in cols] + ["combined_refund_count_30d", "combined_refund_cents_30d"]
    out["order_features"] = _only(pit.order_features, every)
    out["related_accounts"] = lambda spark, sf: (lambda t: pit.related_accounts(t[0], t[1], t[2]))(tables(spark, sf))
    return out


def oracle_sql():
    out = {name: with_views(VIEWS, *FEATURE_PARTS, f"SELECT order_id, {_sql(cols)} FROM feat") for name, cols in GROUPS.items()}
    every = [c for cols in GROUPS.values() for c in cols] + ["combined_refund_count_30d", "combined_refund_cents_30d"]
    out["order_features"] = with_views(VIEWS, *FEATURE_PARTS, f"SELECT order_id, {_sql(every)} FROM feat")
    out["related_accounts"] = with_views("ord dev", PAST, BASE, RELATED, "SELECT order_id, peer FROM peers")
    return out
