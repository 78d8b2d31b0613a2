"""Queries of policy priors, SDK signals and the user-vendor graph with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens.functions import defaults as D
from claimlens.functions import signals
from claimlens.operators import graph, labels
from claimlens.sources.tables import written
from claimlens.sources.views import view, with_views

R6 = lambda *names: [F.round(n, 6).alias(n) for n in names]
r6 = lambda *names: ", ".join(f"round({n}, 6) AS {n}" for n in names)

PLATFORM = [*signals.DEVICE_ALIASES, *signals.VISION_ALIASES]


def policy(spark, sf):
    rows = view(spark, sf, "ord").withColumns({"claim_ts": F.expr("event_ts + make_interval(0, 0, 0, 0, CAST(order_id % 50 AS INT), 0, 0)")})
    out = signals.policy_features(rows)
    return out.select("order_id", *R6(*[c for c in out.columns if c != "order_id"]))


_p = lambda i: "CASE " + " ".join(f"WHEN market = '{m}' AND vertical = '{v}' THEN {x[i]}" for m, v, x in D.POLICY_OVERLAYS) + " " + " ".join(f"WHEN vertical = '{v}' THEN {x[i]}" for v, x in D.POLICY_DEFAULTS.items()) + f" ELSE {D.POLICY_FALLBACK[i]} END"
POLICY = with_views("ord", f"""p AS (SELECT order_id, CAST({_p(0)} AS DOUBLE) AS w, CAST({_p(1)} AS DOUBLE) AS a, CAST({_p(2)} AS DOUBLE) AS b, CAST({_p(3)} AS DOUBLE) AS c,
  CASE WHEN status = 'delivered' THEN CAST(order_id % 50 AS DOUBLE) END AS h FROM ord)""", """
SELECT order_id, w AS policy_claim_window_hours, a AS policy_photo_prior, b AS policy_remedy_cash_bias, c AS policy_returns_allowed, coalesce(h, 0.0) AS hours_since_delivery,
  round(CASE WHEN h IS NULL THEN 0.0 ELSE greatest(0.0, least(1.0, (w - h) / w)) END, 6) AS claim_window_remaining_frac FROM p""")

_num = lambda *ks: "coalesce(" + ", ".join(f"TRY_CAST(json_extract_string(payload, '$.{k}') AS DOUBLE)" for k in ks) + ", 0.0)"


def _norm_sql():
    risk, ai = _num(*signals.DEVICE_ALIASES["device_risk_score"]), _num(*signals.VISION_ALIASES["claim_image_ai_risk"])
    cols = []
    for kind, names in (("device", signals.DEVICE_ALIASES), ("vision", signals.VISION_ALIASES)):
        for n, aliases in names.items():
            if n == "device_risk_score":
                e = f"greatest(0.0, least(100.0, CASE WHEN {risk} > 0 AND {risk} <= 1 THEN {risk} * 100 ELSE {risk} END))"
            elif n == "claim_image_ai_risk":
                e = f"greatest(0.0, least(1.0, CASE WHEN {ai} > 1 THEN {ai} / 100 ELSE {ai} END))"
            else:
                e = f"CASE WHEN {_num(*aliases)} >= 1 THEN 1.0 ELSE 0.0 END"
            cols.append(f"CAST(CASE WHEN confidence >= 0.5 AND kind = '{kind}' THEN {e} ELSE 0.0 END AS DOUBLE) AS {n}")
    return f"""norm AS (SELECT order_id, kind AS source, confidence, confidence >= 0.5 AS accepted, event_ts, {", ".join(cols)}
FROM (SELECT order_id, event_ts, payload, least(greatest(CAST(confidence AS DOUBLE), 0.0), 1.0) AS confidence,
      CASE WHEN source IN ('device', 'device_intelligence', 'fingerprint', 'shield', 'incognia') THEN 'device' ELSE 'vision' END AS kind FROM sdk))"""


NORM = _norm_sql()


def sdk_normalized(spark, sf):
    out = signals.normalize_sdk(view(spark, sf, "sdk"))
    return out.select("order_id", "source", F.col("accepted").cast("int").alias("accepted"), "event_ts", *R6("confidence", *PLATFORM))


def sdk_orders(spark, sf):
    out = signals.apply_sdk(view(spark, sf, "ord"), view(spark, sf, "sdk"))
    return out.select("order_id", *R6("device_signal_confidence", "vision_signal_confidence", *PLATFORM))


_side = lambda k: f"{k} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY event_ts DESC, confidence DESC) AS r FROM norm WHERE accepted AND source = '{k}') WHERE r = 1)"
SDK_PARTS = (NORM, _side("device"), _side("vision"))
SDK_ORDERS = f"""SELECT o.order_id, round(coalesce(device.confidence, 0.0), 6) AS device_signal_confidence, round(coalesce(vision.confidence, 0.0), 6) AS vision_signal_confidence,
  {", ".join(f"round(coalesce({k}.{n}, 0.0), 6) AS {n}" for k, ns in (("device", signals.DEVICE_ALIASES), ("vision", signals.VISION_ALIASES)) for n in ns)}
FROM ord o LEFT JOIN device ON device.order_id = o.order_id LEFT JOIN vision ON vision.order_id = o.order_id"""

_e = lambda n, r, on, orr: (f"{r} / greatest({n}, 1) AS refund_rate", f"greatest({orr}, 0) / greatest({on}, 1) AS base_rate")
RULES = """SELECT *, elev AS elevated FROM (SELECT *, lift * ln(1 + n_orders) * refund_rate AS edge_anomaly, n_orders >= 3 AND n_refunds >= 2 AND lift >= 2.0 AND refund_rate >= 0.25 AS elev
FROM (SELECT *, refund_rate / greatest(base_rate, 1e-6) AS lift FROM (SELECT *, n_refunds / greatest(n_orders, 1) AS refund_rate, greatest(br - n_refunds, 0) / greatest(bn - n_orders, 1) AS base_rate FROM {0})))"""


def _edges_of(rows: str, tag: str) -> list[str]:
    return [
        f"c{tag} AS (SELECT market, vertical, user_id, vendor_id, count(*) AS n_orders, CAST(sum(is_refund) AS BIGINT) AS n_refunds FROM {rows} GROUP BY ALL)",
        f"t{tag} AS (SELECT *, sum(n_orders) OVER (PARTITION BY market, vertical) AS bn, sum(n_refunds) OVER (PARTITION BY market, vertical) AS br FROM c{tag})",
        f"e{tag} AS ({RULES.format(f't{tag}')})",
    ]


def _shuffle(s: int) -> list[str]:
    return [
        f"sh{s} AS (SELECT a.market, a.vertical, a.user_id, b.vendor_id, a.is_refund FROM (SELECT *, row_number() OVER (PARTITION BY market, vertical ORDER BY order_id) AS rk FROM hist) a "
        f"JOIN (SELECT market, vertical, vendor_id, row_number() OVER (PARTITION BY market, vertical ORDER BY md5(CAST(order_id AS VARCHAR) || '|{s}'), order_id) AS rk FROM hist) b ON a.market = b.market AND a.vertical = b.vertical AND a.rk = b.rk)",
        *_edges_of(f"sh{s}", f"s{s}"),
    ]


NULL_PARTS = [*_edges_of("hist", ""), *[x for s in range(3) for x in _shuffle(s)], "cut AS (SELECT quantile_cont(edge_anomaly, 0.95) AS cut FROM (SELECT edge_anomaly FROM es0 UNION ALL SELECT edge_anomaly FROM es1 UNION ALL SELECT edge_anomaly FROM es2))"]
EDGE_PARTS = [*NULL_PARTS, """edges AS (SELECT *, CASE WHEN NOT elevated THEN '' WHEN ud <= 2 AND vd <= 8 THEN 'possible_collusion' WHEN ud >= 4 THEN 'user_scatter_refunds' ELSE 'elevated_uv' END AS mo_tag
FROM (SELECT market, vertical, user_id, vendor_id, n_orders, n_refunds, refund_rate, base_rate, lift, edge_anomaly, elev AND edge_anomaly > cut AS elevated,
      count(*) OVER (PARTITION BY market, vertical, user_id) AS ud, count(*) OVER (PARTITION BY market, vertical, vendor_id) AS vd FROM e, cut))"""]
_node = lambda k: f"""SELECT market, vertical, '{k}' AS entity_kind, CAST({k}_id AS VARCHAR) AS entity_id, count(*) AS n_partners, CAST(sum(n_orders) AS BIGINT) AS n_orders, CAST(sum(n_refunds) AS BIGINT) AS n_refunds, max(edge_anomaly) AS node_anomaly,
 (SELECT mo_tag FROM edges x WHERE x.elevated AND x.market = edges.market AND x.vertical = edges.vertical AND x.{k}_id = edges.{k}_id GROUP BY mo_tag ORDER BY count(*) DESC, mo_tag LIMIT 1) AS mo_tag
 FROM edges WHERE elevated GROUP BY market, vertical, {k}_id"""  # noqa: E731
NODE_PARTS = [*EDGE_PARTS, f"nodes AS ({_node('user')} UNION ALL {_node('vendor')})"]


def edges(spark, sf):
    out = graph.uv_edges(view(spark, sf, "hist"))
    return out.select(*graph.EDGE, "n_orders", "n_refunds", *R6("refund_rate", "base_rate", "lift", "edge_anomaly"), F.col("elevated").cast("int").alias("elevated"), "mo_tag")


def nodes(spark, sf):
    out = graph.uv_nodes(graph.uv_edges(view(spark, sf, "hist")))
    return out.select("market", "vertical", "entity_kind", "entity_id", "n_partners", "n_orders", "n_refunds", *R6("node_anomaly"), F.col("elevated").cast("int").alias("elevated"), "mo_tag")


def null(spark, sf):
    return graph.null_threshold(graph.settled(view(spark, sf, "hist"))).select(*R6("null_threshold"))


GRAPH_COLS = ["uv_edge_anomaly", "uv_edge_lift", "uv_edge_n_orders", "uv_edge_elevated", "uv_mo_possible_collusion", "uv_mo_user_scatter", "uv_mo_elevated_uv", "user_bipartite_anomaly", "vendor_bipartite_anomaly"]


def features(spark, sf):
    found = written(graph.uv_edges(view(spark, sf, "hist")))
    return graph.uv_features(view(spark, sf, "ord"), found, graph.uv_nodes(found)).select("order_id", *R6(*GRAPH_COLS))


GRAPH_FEATURES = """gfeat AS (SELECT o.order_id, coalesce(e.edge_anomaly, 0.0) AS uv_edge_anomaly, coalesce(e.lift, 1.0) AS uv_edge_lift, CAST(coalesce(e.n_orders, 0) AS DOUBLE) AS uv_edge_n_orders, CASE WHEN e.elevated THEN 1.0 ELSE 0.0 END AS uv_edge_elevated,
  CASE WHEN e.mo_tag = 'possible_collusion' THEN 1.0 ELSE 0.0 END AS uv_mo_possible_collusion, CASE WHEN e.mo_tag = 'user_scatter_refunds' THEN 1.0 ELSE 0.0 END AS uv_mo_user_scatter, CASE WHEN e.mo_tag = 'elevated_uv' THEN 1.0 ELSE 0.0 END AS uv_mo_elevated_uv,
  coalesce(u.node_anomaly, 0.0) AS user_bipartite_anomaly, coalesce(v.node_anomaly, 0.0) AS vendor_bipartite_anomaly
FROM ord o LEFT JOIN edges e ON e.market = o.market AND e.vertical = o.vertical AND e.user_id = o.user_id AND e.vendor_id = o.vendor_id
LEFT JOIN nodes u ON u.entity_kind = 'user' AND u.market = o.market AND u.vertical = o.vertical AND u.entity_id = CAST(o.user_id AS VARCHAR)
LEFT JOIN nodes v ON v.entity_kind = 'vendor' AND v.market = o.market AND v.vertical = o.vertical AND v.entity_id = CAST(o.vendor_id AS VARCHAR))"""


def as_of(grain):
    def build(spark, sf):
        out = graph.edge_as_of(view(spark, sf, "ord"), view(spark, sf, "hist"), grain)
        return out.select("order_id", "n_orders", "n_refunds", *R6("refund_rate", "base_rate", "lift", "edge_anomaly"), F.col("elevated").cast("int").alias("elevated"))

    return build


def _as_of_parts(cond: str, tag: str = "") -> list[str]:
    return [
        f"""q{tag} AS (SELECT o.order_id, count(CASE WHEN h.user_id = o.user_id AND h.vendor_id = o.vendor_id THEN 1 END) AS n_orders, CAST(coalesce(sum(CASE WHEN h.user_id = o.user_id AND h.vendor_id = o.vendor_id THEN h.is_refund END), 0) AS BIGINT) AS n_refunds,
 count(h.order_id) AS bn, coalesce(sum(h.is_refund), 0) AS br FROM ord o LEFT JOIN hist h ON h.market = o.market AND h.vertical = o.vertical AND {cond} GROUP BY o.order_id)""",
        f"w{tag} AS ({RULES.format(f'q{tag}')})",
    ]


AS_ORDER = _as_of_parts("h.event_ts <= o.event_ts AND h.order_id <> o.order_id", "o")
AS_DAY = _as_of_parts("h.event_ts < date_trunc('day', o.event_ts)", "d")
_as_select = lambda t: f"SELECT order_id, n_orders, n_refunds, {r6('refund_rate', 'base_rate', 'lift', 'edge_anomaly')}, CAST(elevated AS INT) AS elevated FROM w{t}"


def null_days(spark, sf):
    return graph.null_cut_by_day(graph.settled(view(spark, sf, "hist"))).select(F.col("day").cast("string").alias("day"), *R6("null_threshold"))


def as_of_null(spark, sf):
    """Edges as of each order, tested against the null as of its day."""
    out = graph.edge_as_of(view(spark, sf, "ord"), view(spark, sf, "hist"), "order", null_test=True)
    return out.select("order_id", "n_orders", "n_refunds", *R6("edge_anomaly", "null_threshold"), F.col("elevated").cast("int").alias("elevated"))


def mint_null(spark, sf):
    """Orders that are minted as discoveries with the null test as of their day."""
    out = labels.mint_uv(view(spark, sf, "ord"), view(spark, sf, "hist"), "asof_order", null_test=True)
    return out.where("fraud_label_source = 'discovery'").select("order_id", "abuse_label", "fraud_label")


# The history before each day, vendors permuted within slice and day.
_hd = "(SELECT *, CAST(event_ts AS DATE) AS day FROM hist)"
DAY_NULL = [
    "dsh AS (" + " UNION ALL ".join(f"SELECT {s} AS seed, a.market, a.vertical, a.day, a.user_id, b.vendor_id, a.is_refund FROM (SELECT *, row_number() OVER (PARTITION BY market, vertical, day ORDER BY order_id) AS rk FROM {_hd}) a JOIN (SELECT market, vertical, day, vendor_id, row_number() OVER (PARTITION BY market, vertical, day ORDER BY md5(CAST(order_id AS VARCHAR) || '|{s}'), order_id) AS rk FROM {_hd}) b ON a.market = b.market AND a.vertical = b.vertical AND a.day = b.day AND a.rk = b.rk" for s in range(D.EDGES["shuffles"])) + ")",
    "dlist AS (SELECT unnest(generate_series((SELECT min(day) FROM dsh) + INTERVAL '1' DAY, (SELECT max(day) FROM dsh), INTERVAL '1' DAY))::DATE AS d)",
    "dc AS (SELECT d, seed, market, vertical, user_id, vendor_id, count(*) AS n_orders, CAST(sum(is_refund) AS BIGINT) AS n_refunds FROM dsh JOIN dlist ON day < d GROUP BY ALL)",
    "dt AS (SELECT *, sum(n_orders) OVER (PARTITION BY d, seed, market, vertical) AS bn, sum(n_refunds) OVER (PARTITION BY d, seed, market, vertical) AS br FROM dc)",
    f"de AS ({RULES.format('dt')})",
    f"dcut AS (SELECT d AS day, CASE WHEN (SELECT count(*) FROM hist WHERE CAST(event_ts AS DATE) < d) >= {D.EDGES['min_history']} THEN quantile_cont(edge_anomaly, {D.EDGES['percentile']}) END AS cut FROM de GROUP BY d)",
]
AS_NULL = [*AS_ORDER, *DAY_NULL, "wn AS (SELECT w.*, c.cut, w.elevated AND (c.cut IS NULL OR w.edge_anomaly > c.cut) AS up FROM wo w JOIN ord o ON o.order_id = w.order_id LEFT JOIN dcut c ON c.day = CAST(o.event_ts AS DATE))"]


def node_table(spark, sf):
    out = graph.node_table(graph.uv_edges(view(spark, sf, "hist"), null_test=False))
    return out.select("market", "vertical", "entity_kind", "entity_id", "n_orders", "n_refunds", "n_partners", *R6("mean_lift", "mean_anomaly"))


_nt = lambda k: f"SELECT market, vertical, '{k}' AS entity_kind, CAST({k}_id AS VARCHAR) AS entity_id, CAST(sum(n_orders) AS BIGINT) AS n_orders, CAST(sum(n_refunds) AS BIGINT) AS n_refunds, count(*) AS n_partners, round(avg(lift), 6) AS mean_lift, round(avg(edge_anomaly), 6) AS mean_anomaly FROM e GROUP BY market, vertical, {k}_id"


def queries():
    return {"policy_features": policy, "sdk_normalized": sdk_normalized, "sdk_orders": sdk_orders, "uv_edges": edges, "uv_nodes": nodes, "uv_null_threshold": null, "uv_features": features,
            "uv_edge_asof_order": as_of("order"), "uv_edge_asof_day": as_of("day"), "uv_node_table": node_table, "uv_null_by_day": null_days, "uv_edge_asof_null": as_of_null, "mint_asof_null": mint_null}


def oracle_sql():
    cols = ["refund_rate", "base_rate", "lift", "edge_anomaly"]
    return {
        "policy_features": POLICY,
        "sdk_normalized": with_views("sdk", NORM, f"SELECT order_id, source, CAST(accepted AS INT) AS accepted, event_ts, {r6('confidence', *PLATFORM)} FROM norm"),
        "sdk_orders": with_views("ord sdk", *SDK_PARTS, SDK_ORDERS),
        "uv_edges": with_views("hist", *EDGE_PARTS, f"SELECT market, vertical, user_id, vendor_id, n_orders, n_refunds, {r6(*cols)}, CAST(elevated AS INT) AS elevated, mo_tag FROM edges"),
        "uv_nodes": with_views("hist", *NODE_PARTS, "SELECT market, vertical, entity_kind, entity_id, n_partners, n_orders, n_refunds, round(node_anomaly, 6) AS node_anomaly, 1 AS elevated, mo_tag FROM nodes"),
        "uv_null_threshold": with_views("hist", *NULL_PARTS, "SELECT round(cut, 6) AS null_threshold FROM cut"),
        "uv_features": with_views("ord", *NODE_PARTS, GRAPH_FEATURES, f"SELECT order_id, {r6(*GRAPH_COLS)} FROM gfeat"),
        "uv_edge_asof_order": with_views("ord", *AS_ORDER, _as_select("o")),
        "uv_edge_asof_day": with_views("ord", *AS_DAY, _as_select("d")),
        "uv_null_by_day": with_views("hist", *DAY_NULL, "SELECT CAST(day AS VARCHAR) AS day, round(cut, 6) AS null_threshold FROM dcut"),
        "uv_edge_asof_null": with_views("ord", *AS_NULL, "SELECT order_id, n_orders, n_refunds, round(edge_anomaly, 6) AS edge_anomaly, round(cut, 6) AS null_threshold, CAST(up AS INT) AS elevated FROM wn"),
        "mint_asof_null": with_views("ord", *AS_NULL, "SELECT order_id, 1 AS abuse_label, 1 AS fraud_label FROM wn WHERE up"),
        "uv_node_table": with_views("hist", *_edges_of("hist", ""), f"{_nt('user')} UNION ALL {_nt('vendor')}"),
    }
