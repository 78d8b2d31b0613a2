"""Queries of labels, discovery, sampling and splits with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens.functions import defaults as D
from claimlens.operators import graph, labels, scoring
from claimlens.plans import graph_queries as G
from claimlens.plans.feature_queries import FEATURE_PARTS, VIEWS, features
from claimlens.plans.score_queries import SCORED
from claimlens.sources.tables import written
from claimlens.sources.views import view, with_views

LABELS = list(D.LABEL_COLUMNS)
COLS = ", ".join(LABELS)

_patch = lambda i, c: f"CASE WHEN state = 'applied' THEN CASE outcome " + " ".join(f"WHEN '{k}' THEN {v[i]!r}" for k, v in D.OUTCOMES.items()) + f" END ELSE {repr('') if c == 'fraud_label_source' else 0} END AS {c}"
DISP = [
    "dlast AS (SELECT order_id, disposition AS outcome, disposition_ts AS disp_ts FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY disposition_ts DESC, disposition DESC) AS r FROM disp) WHERE r = 1)",
    f"""lab AS (SELECT order_id, state AS disposition_state, {", ".join(_patch(i, c) for i, c in enumerate(LABELS))} FROM (
 SELECT o.order_id, d.outcome, CASE WHEN d.outcome IS NULL THEN 'none' WHEN d.outcome NOT IN ({", ".join(repr(k) for k in D.OUTCOMES)}) THEN 'unknown' WHEN d.disp_ts >= o.event_ts + INTERVAL '{D.LAG_DAYS}' DAY THEN 'applied' ELSE 'lag' END AS state
 FROM ord o LEFT JOIN dlast d ON d.order_id = o.order_id))""",
]


def labelled(spark, sf):
    return labels.apply_dispositions(view(spark, sf, "ord"), view(spark, sf, "disp"))


def featured(spark, sf, *columns):
    """Features, batch graph features and labels of each order; where columns are named, only those with order_id and the
    labels, and nothing that none of them needs is computed."""
    out = features(spark, sf)
    if not columns or {*columns} & {*graph.FEATURES}:
        found = written(graph.uv_edges(view(spark, sf, "hist")))
        out = out.join(graph.uv_features(view(spark, sf, "ord"), found, graph.uv_nodes(found)), "order_id")
    out = out.join(labelled(spark, sf).select("order_id", *LABELS), "order_id")
    return written(out.select("order_id", *columns, *LABELS) if columns else out)


#: Features that proxy labels, votes and anomaly scores read.
PROXIED = ("uvd_cooccur", "user_refund_rate_30d", "user_orders_30d", "device_cluster_size", "accounts_per_device", "uvd_refund_lift", "uvd_refund_share", "is_emulator", "is_cloned_app", "is_gps_spoof", "customer_courier_same_device", "device_risk_score")
VOTED = ("user_refund_rate_30d", "uv_edge_elevated", "user_lifetime_orders", "accounts_per_device", "claim_reason")


FEATURED = (*FEATURE_PARTS, *G.NODE_PARTS, G.GRAPH_FEATURES, *DISP, f"fl AS (SELECT f.*, g.* EXCLUDE (order_id), {', '.join('l.' + c for c in LABELS)} FROM feat f JOIN gfeat g ON g.order_id = f.order_id JOIN lab l ON l.order_id = f.order_id)")
ALL = "ord dev usr disp"
PROVEN = "(fraud_label_source = 'proven' OR strong_fraud_label >= 1)"
P = D.PROXY
SUPPORT = f"uvd_cooccur >= {P['cooccur']} AND user_refund_rate_30d >= {P['rate']} AND user_orders_30d >= {P['orders']}"
PROXY_HIT = f"""((device_cluster_size >= {P['cluster']} AND accounts_per_device >= {P['accounts']} AND uvd_refund_lift >= {P['lift']} AND uvd_refund_share >= {P['share']} AND {SUPPORT})
 OR ((device_risk_score >= {P['device_risk']} OR is_emulator + is_cloned_app + is_gps_spoof >= {P['flags']}) AND {SUPPORT})) AND NOT {PROVEN} AND fraud_label_source <> 'discovery' AND fraud_label < 1"""
PROXY = f"""px AS (SELECT * REPLACE (CASE WHEN {PROVEN} OR hit THEN 1 ELSE fraud_label END AS fraud_label, CASE WHEN {PROVEN} THEN 'proven' WHEN hit THEN 'proxy' ELSE fraud_label_source END AS fraud_label_source)
 FROM (SELECT *, {PROXY_HIT} AS hit FROM fl))"""


def proxies(spark, sf):
    return labels.proxy_fraud_labels(featured(spark, sf, *PROXIED)).select("order_id", *LABELS)


def weak(spark, sf):
    out = labels.weak_labels(featured(spark, sf, *VOTED))
    return out.select("order_id", "weak_label", F.round("weak_label_confidence", 6).alias("weak_label_confidence"), "weak_lf_votes", *LABELS)


WEAK = """votes AS (SELECT *, v1 + coalesce(v3, 0) + v2 + v4 AS p, 3 + (CASE WHEN v3 IS NULL THEN 0 ELSE 1 END) AS n FROM (
 SELECT *, CASE WHEN user_refund_rate_30d >= 0.35 THEN 1 ELSE 0 END AS v1, CASE WHEN uv_edge_elevated >= 0.5 THEN 1 ELSE 0 END AS v2, CASE WHEN trim(claim_reason) <> '' THEN CASE WHEN user_lifetime_orders <= 2 THEN 1 ELSE 0 END END AS v3,
  CASE WHEN accounts_per_device >= 3 THEN 1 ELSE 0 END AS v4 FROM fl)),
wl AS (SELECT *, CASE WHEN 2 * p = n THEN -1 WHEN 2 * p > n THEN 1 ELSE 0 END AS weak_label, CASE WHEN 2 * p = n THEN 0.0 ELSE greatest(p, n - p) / n END AS weak_label_confidence,
 'high_user_refund_rate=' || v1 || ';elevated_uv_edge=' || v2 || CASE WHEN v3 IS NULL THEN '' ELSE ';claim_thin_history=' || v3 END || ';device_multi_account=' || v4 AS weak_lf_votes FROM votes)"""
WEAK_SELECT = """SELECT order_id, weak_label, round(weak_label_confidence, 6) AS weak_label_confidence, weak_lf_votes, CASE WHEN fraud_label_source <> 'proven' AND weak_label = 1 THEN greatest(abuse_label, 1) ELSE abuse_label END AS abuse_label,
 CASE WHEN weak_label = 1 THEN 1 ELSE 0 END AS abuse_label_weak, CASE WHEN m THEN 1 ELSE fraud_label END AS fraud_label, CASE WHEN m THEN 'discovery' ELSE fraud_label_source END AS fraud_label_source, strong_fraud_label, weak_policy_negative
FROM (SELECT *, fraud_label_source IN ('', 'proxy', 'discovery') AND weak_label = 1 AND fraud_label = 0 AND weak_label_confidence >= 0.75 AS m FROM wl)"""


def mint(mode):
    return lambda spark, sf: labels.mint_uv(labelled(spark, sf), view(spark, sf, "hist"), mode).select("order_id", *LABELS)


def _mint_sql(up):
    return f"""SELECT l.order_id, CASE WHEN u THEN 1 ELSE abuse_label END AS abuse_label, CASE WHEN u THEN 1 ELSE abuse_label_weak END AS abuse_label_weak, CASE WHEN u THEN 1 ELSE fraud_label END AS fraud_label,
 CASE WHEN u THEN 'discovery' ELSE fraud_label_source END AS fraud_label_source, strong_fraud_label, weak_policy_negative FROM (SELECT *, order_id IN ({up}) AND NOT {PROVEN} AS u FROM lab) l"""


BATCH_UP = "SELECT o.order_id FROM ord o JOIN edges e ON e.elevated AND e.market = o.market AND e.vertical = o.vertical AND e.user_id = o.user_id AND e.vendor_id = o.vendor_id"


def robust(spark, sf):
    out = labels.mint_robust_anomaly(featured(spark, sf, *AC))
    return out.select("order_id", F.round("unsupervised_anomaly_score", 6).alias("unsupervised_anomaly_score"), *LABELS)


_x = lambda c: f"coalesce(f.{c}, 0.0)"
AC = labels.ANOMALY_COLUMNS
ANOMALY = [
    "mid AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in AC) + " FROM fl)",
    "dev2 AS (SELECT " + ", ".join(f"quantile_cont(abs({c} - m_{c}), 0.5) AS d_{c}" for c in AC) + " FROM fl, mid)",
    "anom AS (SELECT fl.*, (" + " + ".join(f"least(abs({c} - m_{c}) / CASE WHEN d_{c} = 0 THEN 1.0 ELSE 1.4826 * d_{c} END, 10.0)" for c in AC) + f") / {float(len(AC))} AS score FROM fl, mid, dev2)",
    f"""minted AS (SELECT * REPLACE (CASE WHEN pick THEN 1 ELSE abuse_label END AS abuse_label, CASE WHEN pick THEN 1 ELSE abuse_label_weak END AS abuse_label_weak, CASE WHEN pick THEN 1 ELSE fraud_label END AS fraud_label, CASE WHEN pick THEN 'discovery' ELSE fraud_label_source END AS fraud_label_source)
 FROM (SELECT *, cand AND row_number() OVER (PARTITION BY cand ORDER BY score DESC, order_id) <= (SELECT floor(count(*) * 0.02) FROM fl) AS pick
 FROM (SELECT *, score >= (SELECT quantile_cont(score, 0.95) FROM anom) AND NOT {PROVEN} AND fraud_label_source NOT IN ('proxy', 'proven') AS cand FROM anom)))""",
]


def capped(spark, sf):
    """Edges of the day before mint, then the cap."""
    df = labels.anomaly_scores(labels.mint_uv(featured(spark, sf, *graph.EDGE, *AC), view(spark, sf, "hist"), "batch"))
    df = labels.weak_labels(df, {"always": F.lit(1)}, 0.75)
    return labels.cap_discovery(df).select("order_id", *LABELS)


CAPPED = f"""wk AS (SELECT a.* REPLACE (CASE WHEN a.fraud_label_source <> 'proven' THEN 1 ELSE a.abuse_label END AS abuse_label, 1 AS abuse_label_weak, CASE WHEN a.fraud_label = 0 AND a.fraud_label_source IN ('', 'proxy', 'discovery') THEN 1 ELSE a.fraud_label END AS fraud_label,
 CASE WHEN a.fraud_label = 0 AND a.fraud_label_source IN ('', 'proxy', 'discovery') THEN 'discovery' ELSE a.fraud_label_source END AS fraud_label_source) FROM (
 SELECT * REPLACE (CASE WHEN u THEN 1 ELSE abuse_label END AS abuse_label, CASE WHEN u THEN 1 ELSE fraud_label END AS fraud_label, CASE WHEN u THEN 'discovery' ELSE fraud_label_source END AS fraud_label_source) FROM (SELECT *, order_id IN ({BATCH_UP}) AND NOT {PROVEN} AS u FROM anom)) a),
caps AS (SELECT greatest(CASE WHEN others > 0 THEN least(rws, floor(others * 0.35 / 0.65)) ELSE rws END, CASE WHEN rws > 0 THEN 1 ELSE 0 END) AS cap FROM (SELECT floor(count(*) * 0.05) AS rws, count(CASE WHEN fraud_label >= 1 AND fraud_label_source <> 'discovery' THEN 1 END) AS others FROM wk)),
dr AS (SELECT *, fraud_label_source = 'discovery' AND row_number() OVER (PARTITION BY fraud_label_source = 'discovery' ORDER BY score DESC, order_id) > (SELECT cap FROM caps) AS gone FROM wk)"""
CAPPED_SELECT = "SELECT order_id, CASE WHEN gone AND abuse_label_weak >= 1 THEN 0 ELSE abuse_label END AS abuse_label, CASE WHEN gone THEN 0 ELSE abuse_label_weak END AS abuse_label_weak, CASE WHEN gone THEN 0 ELSE fraud_label END AS fraud_label, CASE WHEN gone THEN '' ELSE fraud_label_source END AS fraud_label_source, strong_fraud_label, weak_policy_negative FROM dr"


def self_train(spark, sf):
    df = scoring.with_standin_scores(scoring.with_entity_scores(featured(spark, sf, *scoring.INPUTS)))
    return labels.mint_self_train(df, 60.0).select("order_id", *LABELS)


SELF = f"""st AS (SELECT *, cand AND row_number() OVER (PARTITION BY cand ORDER BY decision_score DESC, order_id) <= (SELECT floor(count(*) * 0.01) FROM ord) AS pick FROM (
 SELECT s.order_id, s.decision_score, {', '.join('l.' + c for c in LABELS)}, l.fraud_label < 1 AND l.abuse_label < 1 AND NOT {PROVEN} AND s.decision_score >= 60 AS cand FROM scored s JOIN lab l ON l.order_id = s.order_id))"""
SELF_SELECT = "SELECT order_id, CASE WHEN pick THEN 1 ELSE abuse_label END AS abuse_label, CASE WHEN pick THEN 1 ELSE abuse_label_weak END AS abuse_label_weak, CASE WHEN pick THEN 1 ELSE fraud_label END AS fraud_label, CASE WHEN pick THEN 'discovery' ELSE fraud_label_source END AS fraud_label_source, strong_fraud_label, weak_policy_negative FROM st"


def weights(spark, sf):
    df = labels.proxy_fraud_labels(featured(spark, sf, *PROXIED))
    df = labels.with_stacker_target(labels.with_sample_weights(labels.with_sample_weights(df, "abuse"), "fraud", balance=True))
    return df.select("order_id", "weight_abuse", F.round("weight_fraud", 6).alias("weight_fraud"), "stack_y")


WT = D.WEIGHTS
WEIGHTS = f"""wt AS (SELECT *, CASE WHEN abuse_label >= 1 THEN CASE WHEN abuse_label_weak >= 1 THEN {WT['abuse_weak']} ELSE {WT['abuse_positive']} END WHEN weak_policy_negative >= 1 THEN {WT['weak_negative']} ELSE {WT['clean_negative']} END AS wa,
 CASE WHEN fraud_label >= 1 THEN CASE fraud_label_source WHEN 'proven' THEN {WT['fraud_proven']} WHEN 'discovery' THEN {WT['fraud_discovery']} ELSE {WT['fraud_proxy']} END WHEN weak_policy_negative >= 1 THEN {WT['weak_negative']} ELSE {WT['clean_negative']} END AS wf,
 CASE WHEN {PROVEN} OR abuse_label >= 1 THEN 1 ELSE 0 END AS s1, CASE WHEN abuse_label >= 1 OR fraud_label >= 1 THEN 1 ELSE 0 END AS s2 FROM px),
sm AS (SELECT sum(CASE WHEN fraud_label >= 1 THEN wf END) AS p, sum(CASE WHEN fraud_label < 1 THEN wf END) AS n, sum(s1) AS pos, count(*) AS total FROM wt)"""
WEIGHTS_SELECT = "SELECT order_id, CAST(wa AS DOUBLE) AS weight_abuse, round(CASE WHEN fraud_label >= 1 THEN CAST(wf AS DOUBLE) * CAST(n AS DOUBLE) / CAST(p AS DOUBLE) ELSE CAST(wf AS DOUBLE) END, 6) AS weight_fraud, CASE WHEN pos >= 3 AND pos < total THEN s1 ELSE s2 END AS stack_y FROM wt, sm"


def split(spark, sf):
    train, test, _ = labels.time_split(view(spark, sf, "ord"))
    return train.select("order_id", F.lit("train").alias("side")).unionByName(test.select("order_id", F.lit("test").alias("side")))


def sample(spark, sf):
    return labels.stratified_sample(labelled(spark, sf), 200).select("order_id", "abuse_label", "fraud_label")


_sample = lambda n: f"""s AS (SELECT count(*) AS total, count(CASE WHEN abuse_label >= 1 OR fraud_label >= 1 THEN 1 END) AS few FROM lab),
k AS (SELECT total, few, least(few, greatest(1, CAST(round_even({n} * least(0.5, few / total * 2.0), 0) AS BIGINT))) AS a FROM s),
q AS (SELECT {n} - least({n} - a, total - few) AS nf, least({n} - a, total - few) AS nr FROM k)
SELECT order_id, abuse_label, fraud_label FROM (SELECT *, abuse_label >= 1 OR fraud_label >= 1 AS mi, row_number() OVER (PARTITION BY abuse_label >= 1 OR fraud_label >= 1 ORDER BY md5(CAST(order_id AS VARCHAR) || '|42'), order_id) AS r FROM lab), q
WHERE r <= CASE WHEN mi THEN nf ELSE nr END"""  # noqa: E731


def queries():
    return {
        "dispositions": lambda s, d: labelled(s, d).select("order_id", "disposition_state", *LABELS),
        "proxy_labels": proxies, "weak_labels": weak, "mint_uv_daily": mint("asof_daily"), "mint_uv_batch": mint("batch"), "mint_uv_order": mint("asof_order"),
        "mint_anomaly": robust, "cap_discovery": capped, "mint_self_train": self_train, "sample_weights": weights,
        "proven_count": lambda s, d: labels.proven_count(labelled(s, d), view(s, d, "disp")),
        "label_sources": lambda s, d: labels.proxy_fraud_labels(featured(s, d, *PROXIED)).groupBy("fraud_label_source").agg(F.count("*").alias("n"), F.sum("fraud_label").cast("long").alias("n_fraud"), F.sum("abuse_label").cast("long").alias("n_abuse")),
        "time_split": split, "stratified_sample": sample,
        "random_cap": lambda s, d: labels.random_cap(view(s, d, "ord"), 100).select("order_id"),
        "history_lookback": lambda s, d: labels.lookback(view(s, d, "hist"), 180).groupBy("market").agg(F.count("*").alias("n"), F.sum("cents").alias("cents")),
        "history_pruned": lambda s, d: labels.prune_history(view(s, d, "hist"), labels.random_cap(view(s, d, "ord"), 5000), view(s, d, "dev")).select("order_id"),
        "review_sample": lambda s, d: labels.review_sample(view(s, d, "disp")).select("order_id", "disposition", "qa_status"),
        "training_frame": lambda s, d: labels.training_frame(labelled(s, d), view(s, d, "hist"), view(s, d, "dev"), view(s, d, "usr")).select("order_id", F.round("user_refund_rate_30d", 6).alias("user_refund_rate_30d"), "abuse_label"),
    }


def oracle_sql():
    f = lambda *rest: with_views(ALL, *FEATURED, *rest)
    d = lambda *rest: with_views("ord disp", *DISP, *rest)
    two = lambda text: (text.rsplit("\nSELECT", 1)[0], "SELECT" + text.rsplit("\nSELECT", 1)[1])
    return {
        "dispositions": d(f"SELECT order_id, disposition_state, {COLS} FROM lab"),
        "proxy_labels": f(PROXY, f"SELECT order_id, {COLS} FROM px"),
        "weak_labels": f(WEAK, WEAK_SELECT),
        "mint_uv_daily": d(*G.AS_DAY, _mint_sql("SELECT order_id FROM wd WHERE elevated")),
        "mint_uv_batch": d(*G.EDGE_PARTS, _mint_sql(BATCH_UP)),
        "mint_uv_order": d(*G.AS_ORDER, _mint_sql("SELECT order_id FROM wo WHERE elevated")),
        "mint_anomaly": f(*ANOMALY, f"SELECT order_id, round(score, 6) AS unsupervised_anomaly_score, {COLS} FROM minted"),
        "cap_discovery": f(*ANOMALY[:3], CAPPED, CAPPED_SELECT),
        "mint_self_train": with_views(ALL, *FEATURE_PARTS, SCORED, *DISP, SELF, SELF_SELECT),
        "sample_weights": f(PROXY, WEIGHTS, WEIGHTS_SELECT),
        "proven_count": d("SELECT count(DISTINCT order_id) AS n_proven FROM (SELECT order_id FROM disp WHERE disposition IN (" + ", ".join(repr(k) for k, v in D.OUTCOMES.items() if v[3] == "proven") + f") UNION ALL SELECT order_id FROM lab WHERE {PROVEN})"),
        "label_sources": f(PROXY, "SELECT fraud_label_source, count(*) AS n, CAST(sum(fraud_label) AS BIGINT) AS n_fraud, CAST(sum(abuse_label) AS BIGINT) AS n_abuse FROM px GROUP BY 1"),
        "time_split": with_views("ord", "SELECT order_id, CASE WHEN event_ts < (SELECT max(event_ts) - INTERVAL '7' DAY FROM ord) THEN 'train' ELSE 'test' END AS side FROM ord"),
        "stratified_sample": d(*two(_sample(200))),
        "random_cap": with_views("ord", "SELECT order_id FROM ord ORDER BY md5(CAST(order_id AS VARCHAR) || '|42'), order_id LIMIT 100"),
        "history_lookback": with_views("hist", "SELECT market, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM hist WHERE event_ts >= (SELECT max(event_ts) - INTERVAL '180' DAY FROM hist) GROUP BY 1"),
        "history_pruned": with_views("ord dev", "mine AS (SELECT DISTINCT user_id FROM (SELECT user_id FROM ord ORDER BY md5(CAST(order_id AS VARCHAR) || '|42'), order_id LIMIT 5000))", "near AS (SELECT user_id FROM dev WHERE device_id IN (SELECT device_id FROM dev WHERE user_id IN (SELECT user_id FROM mine)))", "SELECT order_id FROM hist WHERE user_id IN (SELECT user_id FROM mine UNION SELECT user_id FROM near)"),
        "review_sample": with_views("disp", f"r AS (SELECT *, disposition IN {labels.HARD} AS h, row_number() OVER (PARTITION BY disposition IN {labels.HARD} ORDER BY md5(CAST(order_id AS VARCHAR) || '|' || disposition || '|42'), order_id) AS k FROM disp)", "c AS (SELECT least(count(CASE WHEN h THEN 1 END), 25) AS nh FROM r)", "SELECT order_id, disposition, 'pending_review' AS qa_status FROM r, c WHERE k <= CASE WHEN h THEN nh ELSE 50 - nh END"),
        "training_frame": with_views(ALL, *DISP, *FEATURE_PARTS, "sm AS (WITH " + _sample(5000) + ")", "SELECT f.order_id, round(f.user_refund_rate_30d, 6) AS user_refund_rate_30d, s.abuse_label FROM feat f JOIN sm s ON s.order_id = f.order_id"),
    }
