"""Queries of the score algebra, decisions, evidence, archive and standing scores with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens.functions import defaults as D
from claimlens.operators import scoring
from claimlens.plans.feature_queries import FEATURE_PARTS, VIEWS, features
from claimlens.sources.views import with_views

SCORES = ["user_score", "driver_score", "vendor_score", "ud_link_score", "uv_link_score", "vd_link_score", "uvd_link_score", "device_cluster_score", "entity_prior", "abuse_score", "fraud_score", "decision_score"]
_over = lambda c, k: f"least(greatest({c} - 1.0, 0.0) * {k}, 100.0)"
_clip = lambda e: f"least(greatest({e}, 0.0), 100.0)"


def _entity(k, scale):
    s = f"least({k}_orders_30d / 5.0, 1.0)"
    gmv = "0.0" if k == "driver" else f"{k}_refund_gmv_pct_30d * 100.0 * {s}"
    return _clip(f"greatest({k}_refund_rate_30d * 100.0 * {s}, {gmv}, least({k}_refund_count_30d * {scale}, 100.0))") + f" AS {k}_score"


def _link(k):
    return _clip(f"least(greatest({k}_refund_lift - 1.0, 0.0) * 30.0, 70.0) * least({k}_cooccur / 3.0, 1.0) + " + ("0.0" if k == "vd" else f"{k}_refund_share * 40.0")) + f" AS {k}_link_score"


PRIOR = _clip("greatest(user_refund_rate_30d * 100.0 * sup, user_refund_gmv_pct_30d * 100.0 * sup, least(user_refund_count_30d * 5.0, 100.0) * sup, user_refund_to_ltv_ratio * 100.0 * life, least(user_lifetime_refund_count * 3.0, 100.0) * life, "
              "driver_refund_rate_30d * 80.0, vendor_refund_rate_30d * 80.0, " + _over("uvd_refund_lift", 35.0) + ", uvd_refund_share * 90.0, " + _over("device_cluster_size", 12.0) + ", " + _over("accounts_per_device", 18.0) + ")")  # fmt: skip
SCORED = f"""scored AS (SELECT *, abuse_score AS a, greatest(abuse_score, fraud_score) AS decision_score FROM (
SELECT *, entity_prior AS abuse_score, greatest(device_cluster_score, uvd_link_score) AS fraud_score FROM (
SELECT *, {_entity('user', 6.0)}, {_entity('driver', 4.0)}, {_entity('vendor', 2.0)}, {", ".join(_link(k) for k in ("ud", "uv", "vd", "uvd"))},
  {_clip("greatest(" + _over("device_cluster_size", 12.0) + ", " + _over("accounts_per_device", 20.0) + ", " + _over("device_churn_30d", 10.0) + ")")} AS device_cluster_score, {PRIOR} AS entity_prior
FROM (SELECT *, least(user_orders_30d / 5.0, 1.0) AS sup, least(user_lifetime_orders / 5.0, 1.0) AS life FROM feat))))"""
_case = lambda i: "CAST(CASE " + " ".join(f"WHEN market = '{m}' AND vertical = '{v}' THEN {t[i]}" for m, v, t in D.LADDER_OVERLAYS) + f" ELSE {D.LADDER[i]} END AS DOUBLE)"
_tiers = lambda values: "CASE tier " + " ".join(f"WHEN '{t}' THEN '{v}'" for t, v in zip(D.TIERS, values, strict=True)) + " END"


def _holds(when):
    out = []
    for k, v in when.items():
        if k == "tiers":
            out.append("tier IN (" + ", ".join(f"'{t}'" for t in v) + ")")
        elif k.startswith("min_"):
            name = k[4:]
            out.append(f"{'0.0' if name == 'uv_mo_possible_collusion' else name} >= {v}")
        else:
            out.append(f"{k} {'>=' if v >= 1 else '<'} 1")
    return " AND ".join(out) or "TRUE"


def _match(rules, field):
    return "CASE " + " ".join(f"WHEN {_holds(r['when'])} THEN '{r[field]}'" for r in rules) + " END"


_sev = lambda e: f"CASE {e} " + " ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(D.EFFECTS)) + " ELSE 0 END"
B = D.BUDGET
DECIDED = [
    f"""laddered AS (SELECT *, {_case(0)} AS soft_friction, {_case(1)} AS hold_review, {_case(2)} AS auto_deny,
 CASE {" ".join(f"WHEN market = '{m}' AND vertical = '{v}' THEN '{m}|{v}'" for m, v, _ in D.LADDER_OVERLAYS)} ELSE '' END AS overlay FROM scored)""",
    f"""tiered AS (SELECT *, {_clip('greatest(decision_score, (0.5 * abuse_score + 0.5 * fraud_score) / 1.0)')} AS combined_score,
 CASE WHEN decision_score >= auto_deny THEN 'auto_deny' WHEN decision_score >= hold_review THEN 'hold_review' WHEN decision_score >= soft_friction THEN 'soft_friction' ELSE 'auto_approve' END AS tier,
 CASE WHEN abuse_score >= 75 OR fraud_score >= 65 THEN 'auto_deny' WHEN abuse_score >= 50 OR fraud_score >= 45 THEN 'hold_review' WHEN abuse_score >= 35 OR fraud_score >= 30 THEN 'soft_friction' ELSE 'auto_approve' END AS head_tier FROM laddered)""",
    f"""ruled AS (SELECT *, {_tiers(D.EFFECTS)} AS base_effect, {_tiers(D.CHALLENGES)} AS base_challenge, {_match(D.EFFECT_RULES, 'mode')} AS em, {_match(D.EFFECT_RULES, 'effect')} AS ev, {_match(D.EFFECT_RULES, 'reason')} AS er, {_match(D.EFFECT_RULES, 'id')} AS effect_rule,
 {_match(D.CHALLENGE_RULES, 'mode')} AS cm, {_match(D.CHALLENGE_RULES, 'challenge')} AS cv, {_match(D.CHALLENGE_RULES, 'reason')} AS cr, {_match(D.CHALLENGE_RULES, 'id')} AS challenge_rule,
 CASE WHEN user_refund_count_30d >= {B['count']} OR user_refund_gmv_pct_30d >= {B['gmv']} THEN 'exhausted' WHEN user_refund_count_30d >= {B['auto']} OR user_refund_gmv_pct_30d >= {B['gmv']} * 0.7 THEN 'elevated' ELSE 'ok' END AS budget_pressure FROM tiered)""",
    f"""decided AS (SELECT *, CASE WHEN floored THEN wish ELSE rule_effect END AS final_effect FROM (
 SELECT *, wish IS NOT NULL AND ({_sev('wish')}) > ({_sev('rule_effect')}) AS floored FROM (
 SELECT *, CASE WHEN em = 'live' THEN ev ELSE base_effect END AS rule_effect, CASE WHEN em = 'shadow' THEN ev END AS shadow_effect, CASE WHEN cm = 'live' THEN cv ELSE base_challenge END AS final_challenge,
  CASE WHEN cm = 'shadow' THEN cv END AS shadow_challenge, CASE budget_pressure WHEN 'exhausted' THEN '{B['exhausted']}' WHEN 'elevated' THEN '{B['elevated']}' END AS wish FROM ruled)))""",
]
#: Everything up to `decided`, for other queries to build on.
PARTS = (*FEATURE_PARTS, SCORED, *DECIDED)
CODES = " || ".join(f"CASE WHEN {m} >= {t} THEN '{c},' ELSE '' END" for c, m, t in [*D.EVIDENCE, *[(f"ENTITY_{k.upper()}_EXTREME", f"{k}_score", 90.0) for k in ("user", "driver", "vendor")]])
REASONS = CODES + " || CASE WHEN er IS NOT NULL THEN er || ',' ELSE '' END || CASE WHEN em = 'shadow' THEN 'EFFECT_SHADOW,' ELSE '' END || CASE WHEN cr IS NOT NULL THEN cr || ',' ELSE '' END || CASE WHEN cm = 'shadow' THEN 'CHALLENGE_SHADOW,' ELSE '' END || CASE WHEN floored THEN 'BUDGET_FLOOR,' ELSE '' END || CASE WHEN overlay <> '' THEN 'OVERLAY_' || overlay || ',' ELSE '' END"


def scored(spark, sf):
    feats = features(spark, sf).withColumn("uv_mo_possible_collusion", F.lit(0.0))
    return scoring.score_orders(feats)


def entity_scores(spark, sf):
    out = scoring.with_standin_scores(scoring.with_entity_scores(features(spark, sf)))
    return out.select("order_id", *[F.round(c, 6).alias(c) for c in SCORES])


DECISION_COLS = ["soft_friction", "hold_review", "auto_deny", "combined_score"]
TEXT_COLS = ["overlay", "tier", "head_tier", "base_effect", "final_effect", "shadow_effect", "effect_rule", "final_challenge", "shadow_challenge", "challenge_rule", "budget_pressure"]


def decisions(spark, sf):
    out = scored(spark, sf).withColumn("head_tier", scoring.head_tier())
    return out.select("order_id", *[F.round(c, 6).alias(c) for c in DECISION_COLS], *TEXT_COLS, F.col("budget_floored").cast("int").alias("budget_floored"))


def evidence(spark, sf):
    out = scored(spark, sf)
    total = F.aggregate(F.map_values("contributions"), F.lit(0.0), lambda a, x: a + x)
    return out.select("order_id", F.size("evidence").alias("n_evidence"), F.concat(F.array_join("reason_codes", ","), F.when(F.size("reason_codes") > 0, ",").otherwise("")).alias("reason_codes"), F.round(total, 6).alias("contributions"))


W = D.EVIDENCE_WEIGHTS
CONTRIB = "abuse_score + fraud_score + entity_prior + " + " + ".join(f"{'device_cluster_score' if k == 'device' else k + '_score' if k in ('user', 'driver', 'vendor') else k + '_link_score'} * {w}" for k, w in W.items())


def keys(spark, sf):
    out = scoring.entity_keys(scored(spark, sf))
    return out.select("order_id", "entity_kind", "entity_key", "score_head", F.round("score", 6).alias("score"), F.round("support", 6).alias("support"))


def _keys_sql(source="decided"):
    parts = []
    for kind, ids in scoring.KINDS.items():
        key = f"'{kind}:' || " + " || '|' || ".join(f"CAST({i} AS VARCHAR)" for i in ids)
        head = D.KIND_HEADS[kind]
        support = f"{kind}_cooccur" if len(kind) < 4 and kind in ("ud", "uv", "vd", "uvd") else "1.0"
        parts.append(f"SELECT order_id, event_ts, market, vertical, status, '{kind}' AS entity_kind, {key} AS entity_key, '{head}' AS score_head, {head}_score AS score, CAST({support} AS DOUBLE) AS support FROM {source}")
    return "okeys AS (" + "\nUNION ALL ".join(parts) + ")"


KEYS = _keys_sql()


def standing(spark, sf):
    return scoring.standing_scores(scoring.entity_keys(scored(spark, sf))).select("entity_kind", "entity_key", F.round("score", 6).alias("score"))


STANDING = "standing AS (SELECT entity_kind, entity_key, arg_max(score, (event_ts, order_id)) AS score FROM okeys WHERE entity_kind IN ('user', 'driver', 'vendor', 'uvd') GROUP BY 1, 2)"


def touched(spark, sf):
    """Scores of orders after the middle of the month meet the standing scores of those before."""
    rows = scoring.entity_keys(scored(spark, sf))
    cut = F.lit("2024-01-16").cast("timestamp")
    old, new = rows.where(F.col("event_ts") < cut), rows.where(F.col("event_ts") >= cut)
    return scoring.touched_orders(new, scoring.standing_scores(old), scoring.standing_scores(new))


TOUCHED = f"""old AS (SELECT entity_key, arg_max(score, (event_ts, order_id)) AS score FROM okeys WHERE entity_kind IN ('user', 'driver', 'vendor', 'uvd') AND event_ts < TIMESTAMP '2024-01-16' GROUP BY 1),
fresh AS (SELECT entity_key, arg_max(score, (event_ts, order_id)) AS score FROM okeys WHERE entity_kind IN ('user', 'driver', 'vendor', 'uvd') AND event_ts >= TIMESTAMP '2024-01-16' GROUP BY 1)
SELECT DISTINCT k.order_id FROM okeys k JOIN fresh f ON f.entity_key = k.entity_key LEFT JOIN old o ON o.entity_key = k.entity_key
WHERE k.event_ts >= TIMESTAMP '2024-01-16' AND abs(f.score - coalesce(o.score, 0.0)) >= {D.ELEVATION_DELTA}"""


def archive(spark, sf):
    return scoring.archive_rows(scoring.snapshots(scored(spark, sf))).select("order_id", "ts", F.col("day").cast("string").alias("day"), "tier", "decision_score", "final_effect", "final_challenge")


def recent(spark, sf):
    rows = scoring.archive_rows(scoring.snapshots(scored(spark, sf)))
    return scoring.archive_recent(rows, 50).select("order_id", "ts", "tier", "final_effect")


def tallies(spark, sf):
    """Counts of tiers and of base, final and shadow effects, with a total of each kind."""
    out = scored(spark, sf).select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in ("tier", "base_effect", "final_effect", "shadow_effect")])).alias("_x")).select("_x.*").where("value is not null")
    return out.rollup("kind", "value").agg(F.count("*").alias("n")).where("kind is not null").select("kind", F.coalesce("value", F.lit("(all)")).alias("value"), "n")


TALLIES = "SELECT kind, coalesce(value, '(all)') AS value, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS kind, {k} AS value FROM decided" for k in ("tier", "base_effect", "final_effect", "shadow_effect")) + ") WHERE value IS NOT NULL GROUP BY GROUPING SETS ((kind, value), (kind))"


def ops_metrics(df):
    """Hold, override and grant rates and refunded cents per order: one row."""
    n = F.count("*")
    rate = lambda c: (F.count_if(c) / n)
    return df.agg(n.alias("n"), rate(F.col("tier") == "hold_review").alias("hold_rate"), rate(F.coalesce(F.col("effect_mode") == "live", F.lit(False)) & (F.col("base_effect") != F.col("final_effect"))).alias("live_override_rate"),
                  rate(F.col("shadow_effect").isNotNull()).alias("shadow_override_rate"), rate(F.col("final_effect") == "refund_auto_grant").alias("refund_grant_rate"),
                  (F.sum(F.when(F.col("final_effect") == "refund_auto_grant", F.col("cents")).otherwise(0)) / 100.0 / n).alias("refund_dollar_per_order"))


def ops(spark, sf):
    out = ops_metrics(scored(spark, sf))
    return out.select("n", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


OPS = """SELECT count(*) AS n, round(avg(CASE WHEN tier = 'hold_review' THEN 1.0 ELSE 0.0 END), 6) AS hold_rate, round(avg(CASE WHEN em = 'live' AND base_effect <> final_effect THEN 1.0 ELSE 0.0 END), 6) AS live_override_rate,
 round(avg(CASE WHEN shadow_effect IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS shadow_override_rate, round(avg(CASE WHEN final_effect = 'refund_auto_grant' THEN 1.0 ELSE 0.0 END), 6) AS refund_grant_rate,
 round(sum(CASE WHEN final_effect = 'refund_auto_grant' THEN cents ELSE 0 END) / 100.0 / count(*), 6) AS refund_dollar_per_order FROM decided"""


def queries():
    return {"entity_scores": entity_scores, "decisions": decisions, "evidence": evidence, "entity_keys": keys, "standing_scores": standing, "touched_orders": touched, "decision_archive": archive, "archive_recent": recent, "tallies": tallies, "ops_metrics": ops}


def oracle_sql():
    r = lambda cols: ", ".join(f"round({c}, 6) AS {c}" for c in cols)
    do = lambda *rest: with_views(VIEWS, *PARTS, *rest)
    n_ev = " + ".join(f"CASE WHEN {m} >= {t} THEN 1 ELSE 0 END" for _, m, t in [*D.EVIDENCE, *[("", f"{k}_score", 90.0) for k in ("user", "driver", "vendor")]])
    return {
        "entity_scores": with_views(VIEWS, *FEATURE_PARTS, SCORED, f"SELECT order_id, {r(SCORES)} FROM scored"),
        "decisions": do(f"SELECT order_id, {r(DECISION_COLS)}, {', '.join(TEXT_COLS)}, CAST(floored AS INT) AS budget_floored FROM decided"),
        "evidence": do(f"SELECT order_id, {n_ev} AS n_evidence, {REASONS} AS reason_codes, round({CONTRIB}, 6) AS contributions FROM decided"),
        "entity_keys": do(KEYS, "SELECT order_id, entity_kind, entity_key, score_head, round(score, 6) AS score, round(support, 6) AS support FROM okeys"),
        "standing_scores": do(KEYS, STANDING, "SELECT entity_kind, entity_key, round(score, 6) AS score FROM standing"),
        "touched_orders": do(KEYS + ",\n" + TOUCHED.split("\nSELECT DISTINCT")[0], "SELECT DISTINCT" + TOUCHED.split("\nSELECT DISTINCT")[1]),
        "decision_archive": do("SELECT order_id, event_ts AS ts, CAST(CAST(event_ts AS DATE) AS VARCHAR) AS day, tier, round(decision_score, 6) AS decision_score, final_effect, final_challenge FROM decided"),
        "archive_recent": do("SELECT order_id, event_ts AS ts, tier, final_effect FROM decided ORDER BY event_ts DESC, order_id DESC LIMIT 50"),
        "tallies": do(TALLIES),
        "ops_metrics": do(OPS),
    }
