"""Queries of behaviour baselines, cohorts and the gate with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens.functions import defaults as D
from claimlens.operators import baselines as B
from claimlens.operators import scoring
from claimlens.plans.feature_queries import FEATURE_PARTS, VIEWS, features
from claimlens.plans.score_queries import KEYS, SCORED
from claimlens.sources.tables import written
from claimlens.sources.views import with_views

C = D.BASELINE
SETTLED = "(" + ", ".join(f"'{s}'" for s in C["settled"]) + ")"
PAIR = f"entity_kind IN ('ud', 'uv', 'vd', 'uvd') AND support < {C['pair_min']}"
W = "PARTITION BY entity_key, market, vertical ORDER BY event_ts, order_id"
HISTORY = [
    KEYS.replace("FROM decided", "FROM scored"),
    f"ob AS (SELECT *, CASE score_head WHEN 'fraud' THEN {C['under_fraud']} ELSE {C['under_abuse']} END AS ut FROM okeys WHERE status IN {SETTLED})",
    f"h1 AS (SELECT *, list_transform(list_filter(l, lambda x: x.t >= event_ts - INTERVAL '{C['days']}' DAY), lambda x: x.s) AS a FROM (SELECT *, list({{'t': event_ts, 's': score}}) OVER ({W} ROWS BETWEEN {C['events'] - 1} PRECEDING AND CURRENT ROW) AS l FROM ob))",
    "h2 AS (SELECT *, len(a) AS n_observations, len(u) AS n_under, CASE WHEN len(u) > 0 THEN u ELSE a END AS m FROM (SELECT *, list_filter(a, lambda s: s < ut) AS u FROM h1))",
    "h3 AS (SELECT *, n_under / n_observations AS under_rate, list_sum(m) / len(m) AS baseline_mean, list_sort(m)[CAST(floor(len(m) / 2) AS BIGINT) + 1] AS baseline_p50, list_sort(m)[greatest(1, CAST(floor(len(m) * 0.9) AS BIGINT))] AS baseline_p90, score < ut AS un FROM h2)",
    f"h4 AS (SELECT *, score / greatest(baseline_mean, 1e-6) AS lift, score - baseline_mean AS abs_delta, (score - baseline_mean >= {C['delta']} OR score / greatest(baseline_mean, 1e-6) >= {C['lift']}) AND NOT un AS up FROM h3)",
    f"h5 AS (SELECT *, sum(CASE WHEN un THEN 0 ELSE 1 END) OVER ({W}) AS iu, sum(CASE WHEN up THEN 0 ELSE 1 END) OVER ({W}) AS ie, CASE WHEN NOT ({PAIR}) AND n_observations >= {C['min_obs']} AND under_rate >= {C['min_under_rate']} THEN 1 WHEN under_rate < {C['revoke']} THEN 0 END AS mark FROM h4)",
    f"bh AS (SELECT *, sum(CASE WHEN un THEN 1 ELSE 0 END) OVER (PARTITION BY entity_key, market, vertical, iu ORDER BY event_ts, order_id) AS under_streak, sum(CASE WHEN up THEN 1 ELSE 0 END) OVER (PARTITION BY entity_key, market, vertical, ie ORDER BY event_ts, order_id) AS elevated_streak, coalesce(last_value(mark IGNORE NULLS) OVER ({W}), 0) = 1 AS is_clean FROM h5)",
]
COHORT = [
    f"cr AS (SELECT s.order_id, event_ts, market, vertical, CASE WHEN user_days_since_signup < {C['new_days']} THEN 'new' WHEN user_days_since_signup < {C['mid_days']} THEN 'mid' ELSE 'mature' END AS tenure_bucket, x.h AS score_head, CASE x.h WHEN 'abuse' THEN abuse_score ELSE fraud_score END AS score FROM scored s, (VALUES ('abuse'), ('fraud')) x(h) WHERE status IN {SETTLED})",
    f"cw AS (SELECT *, list(score) OVER (PARTITION BY market, vertical, tenure_bucket, score_head ORDER BY event_ts, order_id ROWS BETWEEN {C['cohort_events'] - 1} PRECEDING AND CURRENT ROW) AS a FROM cr)",
    f"ch AS (SELECT *, CASE WHEN cohort_n >= {C['cohort_support']} THEN score / greatest(cohort_p50, 1e-6) ELSE 1.0 END AS cohort_lift FROM (SELECT *, len(a) AS cohort_n, list_sum(a) / len(a) AS cohort_mean, list_sort(a)[CAST(floor(len(a) / 2) AS BIGINT) + 1] AS cohort_p50, list_sort(a)[greatest(1, CAST(floor(len(a) * 0.9) AS BIGINT))] AS cohort_p90 FROM cw))",
]
_disc = lambda l, d, ml, md: f"CASE WHEN {l} < {ml} AND {d} < {md} THEN 0.0 ELSE least({C['max_discount']}, greatest(greatest(0.0, {l} - 1) * {C['per_lift']}, greatest(0.0, {d} / 100.0) * {C['max_discount']})) END"
GATE = [
    f"""sg AS (SELECT *, greatest(own, peer) AS disc, peer > own AS by_cohort FROM (SELECT b.*, CASE WHEN ({PAIR}) OR NOT is_clean OR elevated_streak < {C['streak']} OR NOT (abs_delta >= {C['delta']} OR lift >= {C['lift']}) THEN 0.0 ELSE {_disc('lift', 'abs_delta', C['lift'], C['delta'])} END AS own,
 coalesce(CASE WHEN c.cohort_n >= {C['cohort_support']} AND (c.cohort_lift >= {C['cohort_lift']} OR b.score - c.cohort_p50 >= {C['cohort_delta']}) THEN {_disc('c.cohort_lift', '(b.score - c.cohort_p50)', C['cohort_lift'], C['cohort_delta'])} ELSE 0.0 END, 0.0) AS peer FROM bh b LEFT JOIN ch c ON c.order_id = b.order_id AND c.score_head = b.score_head))""",
    f"""gt AS (SELECT g.*, greatest(abuse_discount, fraud_discount) * 100.0 AS raw, abuse_discount <= 0 AND fraud_discount <= 0 AND u AND d AND s.abuse_score <= {C['trust_abuse']} AND s.fraud_score <= {C['trust_fraud']} AS trust FROM (
 SELECT order_id, coalesce(max(CASE WHEN score_head = 'abuse' THEN disc END), 0.0) AS abuse_discount, coalesce(max(CASE WHEN score_head = 'fraud' THEN disc END), 0.0) AS fraud_discount, coalesce(bool_or(CASE WHEN entity_kind = 'user' THEN is_clean END), FALSE) AS u, coalesce(bool_or(CASE WHEN entity_kind = 'device' THEN is_clean END), FALSE) AS d FROM sg GROUP BY 1) g JOIN scored s ON s.order_id = g.order_id)""",
]
PARTS = (*FEATURE_PARTS, SCORED)


def scored(spark, sf):
    return written(scoring.with_standin_scores(scoring.with_entity_scores(features(spark, sf))))


def history_of(df):
    return B.baseline_history(B.settled_observations(scoring.entity_keys(df)))


R = lambda *names: [F.round(n, 6).alias(n) for n in names]


def history(spark, sf):
    out = history_of(scored(spark, sf))
    return out.select("order_id", "entity_kind", "entity_key", "n_observations", "n_under", *R("under_rate", "baseline_mean", "baseline_p50", "baseline_p90"), F.col("under_streak").cast("long").alias("under_streak"), F.col("elevated_streak").cast("long").alias("elevated_streak"), F.col("is_clean").cast("int").alias("is_clean"))


def clean(spark, sf):
    out = B.latest_baselines(history_of(scored(spark, sf)))
    return out.where("is_clean").select("entity_kind", "entity_key", "market", "vertical", *R("baseline_mean"))


def cohorts(spark, sf):
    return B.cohort_history(scored(spark, sf)).select("order_id", "score_head", "tenure_bucket", "cohort_n", *R("cohort_mean", "cohort_p50", "cohort_p90", "cohort_lift"))


def gate(spark, sf):
    df = scored(spark, sf)
    out = B.baseline_gate(B.signals(history_of(df), B.cohort_history(df)), df)
    return out.select("order_id", *R("abuse_discount", "fraud_discount", "abuse_relax", "fraud_relax", "hil_remainder", "tighten", "target_precision"), F.col("hil_required").cast("int").alias("hil_required"), F.col("trust_credit").cast("int").alias("trust_credit"))


def warped(spark, sf):
    df = scored(spark, sf)
    g = B.baseline_gate(B.signals(history_of(df), B.cohort_history(df)), df)
    return B.warp_thresholds(scoring.with_thresholds(df), g).select("order_id", *R("soft_friction", "hold_review", "auto_deny"))


def queries():
    return {"baseline_history": history, "clean_baselines": clean, "cohort_history": cohorts, "baseline_gate": gate, "warped_thresholds": warped}


def oracle_sql():
    r = lambda *names: ", ".join(f"round({n}, 6) AS {n}" for n in names)
    do = lambda *rest: with_views(VIEWS, *PARTS, *rest)
    t = lambda i: "CAST(CASE " + " ".join(f"WHEN s.market = '{m}' AND s.vertical = '{v}' THEN {x[i]}" for m, v, x in D.LADDER_OVERLAYS) + f" ELSE {D.LADDER[i]} END AS DOUBLE)"
    warp = lambda i, n: f"round(least(100.0, greatest(0.0, {t(i)} - least(coalesce(g.raw, 0.0), {C['max_relax']})) + CASE WHEN g.trust THEN {C['tighten']} ELSE 0.0 END), 6) AS {n}"
    return {
        "baseline_history": do(*HISTORY, f"SELECT order_id, entity_kind, entity_key, CAST(n_observations AS INT) AS n_observations, CAST(n_under AS INT) AS n_under, {r('under_rate', 'baseline_mean', 'baseline_p50', 'baseline_p90')}, CAST(under_streak AS BIGINT) AS under_streak, CAST(elevated_streak AS BIGINT) AS elevated_streak, CAST(is_clean AS INT) AS is_clean FROM bh"),
        "clean_baselines": do(*HISTORY, "SELECT entity_kind, entity_key, market, vertical, round(baseline_mean, 6) AS baseline_mean FROM (SELECT *, row_number() OVER (PARTITION BY entity_key, market, vertical ORDER BY event_ts DESC, order_id DESC) AS k FROM bh) WHERE k = 1 AND is_clean"),
        "cohort_history": do(*COHORT, f"SELECT order_id, score_head, tenure_bucket, CAST(cohort_n AS INT) AS cohort_n, {r('cohort_mean', 'cohort_p50', 'cohort_p90', 'cohort_lift')} FROM ch"),
        "baseline_gate": do(*HISTORY, *COHORT, *GATE, f"SELECT order_id, {r('abuse_discount', 'fraud_discount')}, round(least(abuse_discount * 100.0, {C['max_relax']}), 6) AS abuse_relax, round(least(fraud_discount * 100.0, {C['max_relax']}), 6) AS fraud_relax, round(greatest(0.0, raw - {C['max_relax']}), 6) AS hil_remainder, CAST(CASE WHEN trust THEN {C['tighten']} ELSE 0.0 END AS DOUBLE) AS tighten, round(greatest(0.5, {C['target']} - greatest(abuse_discount, fraud_discount)), 6) AS target_precision, CAST(raw > {C['max_relax']} + 1e-9 AS INT) AS hil_required, CAST(trust AS INT) AS trust_credit FROM gt"),
        "warped_thresholds": do(*HISTORY, *COHORT, *GATE, f"SELECT s.order_id, {warp(0, 'soft_friction')}, {warp(1, 'hold_review')}, {warp(2, 'auto_deny')} FROM scored s LEFT JOIN gt g ON g.order_id = s.order_id"),
    }
