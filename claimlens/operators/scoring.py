"""From features to a decision: entity and link scores, tiers, effects, challenges, budget, evidence, snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions import defaults as D


def clip(c: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def col(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def entity_score(kind: str, scale: float) -> Column:
    support = F.least(col(f"{kind}_orders_30d") / 5.0, F.lit(1.0))
    gmv = F.lit(0.0) if kind == "driver" else col(f"{kind}_refund_gmv_pct_30d") * 100.0 * support
    return clip(F.greatest(col(f"{kind}_refund_rate_30d") * 100.0 * support, gmv, F.least(col(f"{kind}_refund_count_30d") * scale, F.lit(100.0))))


def link_score(k: str) -> Column:
    rise = F.least(F.greatest(col(f"{k}_refund_lift") - 1.0, F.lit(0.0)) * 30.0, F.lit(70.0)) * F.least(col(f"{k}_cooccur") / 3.0, F.lit(1.0))
    return clip(rise + (F.lit(0.0) if k == "vd" else col(f"{k}_refund_share") * 40.0))


def over_one(name: str, scale: float) -> Column:
    return F.least(F.greatest(col(name) - 1.0, F.lit(0.0)) * scale, F.lit(100.0))


def device_score() -> Column:
    return clip(F.greatest(over_one("device_cluster_size", 12.0), over_one("accounts_per_device", 20.0), over_one("device_churn_30d", 10.0)))


def entity_prior() -> Column:
    support, life = F.least(col("user_orders_30d") / 5.0, F.lit(1.0)), F.least(col("user_lifetime_orders") / 5.0, F.lit(1.0))
    return clip(F.greatest(
        col("user_refund_rate_30d") * 100.0 * support, col("user_refund_gmv_pct_30d") * 100.0 * support, F.least(col("user_refund_count_30d") * 5.0, F.lit(100.0)) * support,
        col("user_refund_to_ltv_ratio") * 100.0 * life, F.least(col("user_lifetime_refund_count") * 3.0, F.lit(100.0)) * life,
        col("driver_refund_rate_30d") * 80.0, col("vendor_refund_rate_30d") * 80.0, over_one("uvd_refund_lift", 35.0), col("uvd_refund_share") * 90.0, over_one("device_cluster_size", 12.0), over_one("accounts_per_device", 18.0)))


#: Features that with_entity_scores reads.
INPUTS = (*[f"{k}_{c}" for k in ("user", "driver", "vendor") for c in ("orders_30d", "refund_rate_30d", "refund_count_30d")], "user_refund_gmv_pct_30d", "vendor_refund_gmv_pct_30d", *[f"{k}_{c}" for k in ("ud", "uv", "vd", "uvd") for c in ("cooccur", "refund_lift", "refund_share")],
          "device_cluster_size", "accounts_per_device", "device_churn_30d", "user_lifetime_orders", "user_lifetime_refund_count", "user_refund_to_ltv_ratio")


def with_entity_scores(features: DataFrame) -> DataFrame:
    """Entity, link and device scores and the entity prior, 0 to 100."""
    cols = {f"{k}_score": entity_score(k, s) for k, s in (("user", 6.0), ("driver", 4.0), ("vendor", 2.0))}
    cols |= {f"{k}_link_score": link_score(k) for k in ("ud", "uv", "vd", "uvd")}
    return features.withColumns(cols | {"device_cluster_score": device_score(), "entity_prior": entity_prior()})


def with_standin_scores(scored: DataFrame) -> DataFrame:
    """abuse, fraud and decision scores by rule, where no model has been fitted."""
    out = scored.withColumns({"abuse_score": F.col("entity_prior"), "fraud_score": F.greatest("device_cluster_score", "uvd_link_score")})
    return out.withColumn("decision_score", F.greatest("abuse_score", "fraud_score"))


def with_thresholds(df: DataFrame, base=D.LADDER, overlays=None) -> DataFrame:
    """soft, hold and deny of the most specific overlay (market and vertical over market over vertical over
    bare; the first of equals), else the base ladder; and which overlay it was."""
    overlays = D.LADDER_OVERLAYS if overlays is None else overlays
    rank = sorted(enumerate(overlays), key=lambda x: (-(2 * bool(x[1][0]) + bool(x[1][1])), x[0]))
    market, vertical = F.upper(F.coalesce("market", F.lit(""))), F.lower(F.coalesce("vertical", F.lit("")))
    hits = [((F.lit(not m) | (market == (m or "").upper())) & (F.lit(not v) | (vertical == (v or "").lower())), f"{m or '*'}|{v or '*'}", t) for _, (m, v, t) in rank]

    def pick(default, values) -> Column:
        return reduce(lambda rest, x: F.when(x[0], F.lit(x[1])).otherwise(rest), reversed([(h[0], v) for h, v in zip(hits, values, strict=True)]), F.lit(default))

    cols = {n: pick(base[i], [h[2][i] for h in hits]) for i, n in enumerate(("soft_friction", "hold_review", "auto_deny"))}
    return df.withColumns(cols | {"overlay": pick("", [h[1] for h in hits])})


def ladder_tier(score: Column, soft: Column, hold: Column, deny: Column) -> Column:
    return F.when(score >= deny, D.TIERS[3]).when(score >= hold, D.TIERS[2]).when(score >= soft, D.TIERS[1]).otherwise(D.TIERS[0])


def head_tier(warped: bool = False) -> Column:
    """Either head over its own ladder: the default one, or the columns {head}_soft_friction and so on."""
    levels = ("soft_friction", "hold_review", "auto_deny")
    ladders = {"abuse": D.ABUSE_LADDER, "fraud": D.FRAUD_LADDER}
    at = lambda h, i: F.col(f"{h}_{levels[i]}") if warped else F.lit(ladders[h][i])
    over = [reduce(lambda a, b: a | b, [F.col(f"{h}_score") >= at(h, i) for h in ladders]) for i in range(3)]
    return F.when(over[2], D.TIERS[3]).when(over[1], D.TIERS[2]).when(over[0], D.TIERS[1]).otherwise(D.TIERS[0])


def band_tier(score: Column) -> Column:
    return F.when(score <= 25, D.TIERS[0]).when(score <= 50, D.TIERS[1]).when(score <= 75, D.TIERS[2]).otherwise(D.TIERS[3])


def with_decision(df: DataFrame, mode: str = "decision_primary", display=(0.5, 0.5)) -> DataFrame:
    """hard_gate, combined_score and tier. Needs scores and thresholds; prior_strong_fraud gates where present."""
    gate = (F.coalesce(F.col("prior_strong_fraud").cast("double"), F.lit(0.0)) >= 1) if "prior_strong_fraud" in df.columns else F.lit(False)
    a, f = display if sum(display) > 0 else (0.5, 0.5)
    combined = clip(F.greatest(F.col("decision_score"), (a * F.col("abuse_score") + f * F.col("fraud_score")) / (a + f)))
    tier = {
        "decision_primary": ladder_tier(F.col("decision_score"), F.col("soft_friction"), F.col("hold_review"), F.col("auto_deny")),
        "learning_primary": head_tier("abuse_soft_friction" in df.columns),
        "score_only": band_tier(combined),
    }[mode]
    return df.withColumns({"hard_gate": gate, "combined_score": F.when(gate, F.greatest(combined, F.lit(90.0))).otherwise(combined), "tier": F.when(gate, D.TIERS[3]).otherwise(tier)})


def by_tier(values: tuple[str, ...]) -> Column:
    return reduce(lambda rest, x: F.when(F.col("tier") == x[0], x[1]).otherwise(rest), zip(D.TIERS, values, strict=True), F.lit(None).cast("string"))


def rule_holds(when: dict) -> Column:
    """All conditions of a rule: min_x floors a column, tiers lists tiers, a bare name wants a flag set or not."""
    parts = [F.lit(True)]
    for key, value in when.items():
        if key == "tiers":
            parts.append(F.col("tier").isin(*value))
        elif key == "min_decision_score":
            parts.append(F.col("decision_score") >= float(value))
        elif key.startswith("min_"):
            parts.append(col(key[4:]) >= float(value))
        else:
            parts.append(col(key) >= 1 if value >= 1 else col(key) < 1)
    return reduce(lambda a, b: a & b, parts)


def first_match(rules: list[dict], what: str) -> Column:
    """(id, mode, value, reason) of the first rule that holds; a shadow rule ends the search too."""
    out = F.lit(None).cast("struct<id:string,mode:string,value:string,reason:string>")
    for r in reversed(rules):
        hit = F.struct(F.lit(r["id"]).alias("id"), F.lit(r["mode"]).alias("mode"), F.lit(r[what]).alias("value"), F.lit(r["reason"]).alias("reason"))
        out = F.when(rule_holds(r["when"]), hit).otherwise(out)
    return out


def with_rules(df: DataFrame, kind: str, base: tuple[str, ...], rules: list[dict], kill_switch: bool = False, enabled: bool = True) -> DataFrame:
    """base_, final_ and shadow_{kind}, {kind}_rule and {kind}_reasons."""
    tag = kind.upper()
    df = df.withColumn(f"base_{kind}", by_tier(base))
    if kill_switch or not enabled:
        final = F.col(f"base_{kind}") if enabled or kind == "effect" else F.lit("none")
        reasons = F.array(F.lit(f"{tag}_KILL_SWITCH")) if kill_switch else F.array().cast("array<string>")
        return df.withColumns({f"final_{kind}": final, f"shadow_{kind}": F.lit(None).cast("string"), f"{kind}_rule": F.lit(None).cast("string"), f"{kind}_mode": F.lit(None).cast("string"), f"{kind}_reasons": reasons})
    df = df.withColumn("_hit", first_match(rules, kind))
    live, shadow = F.col("_hit.mode") == "live", F.col("_hit.mode") == "shadow"
    reasons = F.when(live, F.array("_hit.reason")).when(shadow, F.array(F.col("_hit.reason"), F.lit(f"{tag}_SHADOW"))).otherwise(F.array().cast("array<string>"))
    return df.withColumns({f"final_{kind}": F.when(live, F.col("_hit.value")).otherwise(F.col(f"base_{kind}")), f"shadow_{kind}": F.when(shadow, F.col("_hit.value")), f"{kind}_rule": F.col("_hit.id"), f"{kind}_mode": F.col("_hit.mode"), f"{kind}_reasons": reasons}).drop("_hit")


def with_effect(df: DataFrame, rules: list[dict] | None = None, kill_switch: bool = False, enabled: bool = True) -> DataFrame:
    return with_rules(df, "effect", D.EFFECTS, D.EFFECT_RULES if rules is None else rules, kill_switch, enabled)


def with_challenge(df: DataFrame, rules: list[dict] | None = None, kill_switch: bool = False, enabled: bool = True) -> DataFrame:
    return with_rules(df, "challenge", D.CHALLENGES, D.CHALLENGE_RULES if rules is None else rules, kill_switch, enabled)


def severity(effect: Column) -> Column:
    return reduce(lambda rest, x: F.when(effect == x[1], F.lit(x[0])).otherwise(rest), enumerate(D.EFFECTS), F.lit(0))


def with_budget(df: DataFrame, cfg: dict | None = None, floor: bool = True) -> DataFrame:
    """budget_pressure, and final_effect raised to what the pressure suggests where that is stricter."""
    c = D.BUDGET if cfg is None else cfg
    n, g = col("user_refund_count_30d"), col("user_refund_gmv_pct_30d")
    pressure = F.when((n >= c["count"]) | (g >= c["gmv"]), "exhausted").when((n >= c["auto"]) | (g >= c["gmv"] * 0.7), "elevated").otherwise("ok")
    df = df.withColumn("budget_pressure", pressure)
    wish = F.when(F.col("budget_pressure") == "exhausted", c["exhausted"]).when(F.col("budget_pressure") == "elevated", c["elevated"])
    up = F.lit(floor) & wish.isNotNull() & (severity(wish) > severity(F.col("final_effect")))
    df = df.withColumn("budget_floored", F.coalesce(up, F.lit(False)))
    return df.withColumn("final_effect", F.when(F.col("budget_floored"), wish).otherwise(F.col("final_effect")))


def those(items: list[tuple[Column, Column]]) -> Column:
    """The array of the items whose condition holds. Arrays of one or none are joined, as generated code does that, while a
    lambda over an array makes Spark interpret all that goes in, scores included."""
    return F.concat(*[F.when(holds, F.array(x)).otherwise(F.slice(F.array(x), 1, 0)) for holds, x in items])


def evidence_items() -> Column:
    """(code, metric, value, threshold) of each check that holds, and of entity scores from 90 on."""
    checks = [F.struct(F.lit(c).alias("code"), F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), F.lit(t).alias("threshold")) for c, m, t in D.EVIDENCE]
    checks += [F.struct(F.lit(f"ENTITY_{k.upper()}_EXTREME").alias("code"), F.lit(f"{k}_score").alias("metric"), F.col(f"{k}_score").alias("value"), F.lit(90.0).alias("threshold")) for k in ("user", "driver", "vendor")]
    return those([(x["value"] >= x["threshold"], x) for x in checks])


def contributions() -> Column:
    parts = {"abuse_score": F.col("abuse_score"), "fraud_score": F.col("fraud_score"), "entity_prior": F.col("entity_prior")}
    for k, w in D.EVIDENCE_WEIGHTS.items():
        name = "device_cluster_score" if k == "device" else f"{k}_score" if k in ("user", "driver", "vendor") else f"{k}_link_score"
        parts[k] = F.col(name) * w
    return F.map_from_arrays(F.array(*[F.lit(k) for k in parts]), F.array(*parts.values()))


def with_evidence(df: DataFrame) -> DataFrame:
    df = df.withColumns({"evidence": evidence_items(), "contributions": contributions()})
    more = [(F.col("budget_floored"), F.lit("BUDGET_FLOOR")), (F.col("overlay") != "", F.concat(F.lit("OVERLAY_"), F.col("overlay")))]
    codes = F.concat(F.col("evidence.code"), F.col("effect_reasons"), F.col("challenge_reasons"), those(more))
    return df.withColumn("reason_codes", codes)


def score_orders(features: DataFrame, mode: str = "decision_primary") -> DataFrame:
    """The whole ladder over features that carry abuse_score, fraud_score and decision_score, or the stand-ins."""
    df = with_entity_scores(features)
    if "decision_score" not in df.columns:
        df = with_standin_scores(df)
    df = with_decision(with_thresholds(df), mode)
    return with_evidence(with_budget(with_challenge(with_effect(df))))


def snapshots(scored: DataFrame, *more: Column) -> DataFrame:
    """The stored form: one nested row per order, with further columns if asked for."""
    pick = lambda names, suffix: F.struct(*[F.col(f"{n}{suffix}").alias(n) for n in names])
    return scored.select("order_id", "market", "vertical", "event_ts", "abuse_score", "fraud_score", "decision_score", "combined_score", "tier", pick(("user", "driver", "vendor"), "_score").alias("entity_scores"), pick(("ud", "uv", "vd", "uvd"), "_link_score").alias("link_scores"),
                         "base_effect", "final_effect", "shadow_effect", "final_challenge", "shadow_challenge", "budget_pressure", "budget_floored", "reason_codes", F.struct("evidence", "contributions").alias("evidence_pack"), *more)


LABELS_OF_THE_ORDER = ("abuse_label", "abuse_label_weak", "fraud_label", "fraud_label_source", "strong_fraud_label", "weak_policy_negative", "disposition", "disposition_ts")


def strip_labels(df: DataFrame) -> DataFrame:
    """Without the order's own labels; prior_strong_fraud stays."""
    return df.drop(*LABELS_OF_THE_ORDER)


KINDS = {"user": ["user_id"], "driver": ["driver_id"], "vendor": ["vendor_id"], "device": ["device_id"], "ud": ["user_id", "driver_id"], "uv": ["user_id", "vendor_id"], "vd": ["vendor_id", "driver_id"], "uvd": ["user_id", "vendor_id", "driver_id"]}


def entity_keys(scored: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Eight rows per order: entity_kind, entity_key, head, score of that head and support (of pairs: how often seen together),
    with further columns if asked for."""
    one = []
    for kind, ids in KINDS.items():
        key = F.when(reduce(lambda a, b: a & b, [F.col(i).isNotNull() & (F.col(i).cast("string") != "") for i in ids]), F.concat(F.lit(f"{kind}:"), F.concat_ws("|", *[F.col(i).cast("string") for i in ids])))
        head = D.KIND_HEADS[kind]
        support = F.col(f"{kind}_cooccur").cast("double") if f"{kind}_cooccur" in scored.columns else F.lit(1.0)
        one.append(F.struct(F.lit(kind).alias("entity_kind"), key.alias("entity_key"), F.lit(head).alias("score_head"), F.col(f"{head}_score").alias("score"), support.alias("support")))
    keep = [*[c for c in ("order_id", "event_ts", "market", "vertical", "status") if c in scored.columns], *keep]
    out = scored.select(*keep, F.explode(F.filter(F.array(*one), lambda x: x["entity_key"].isNotNull())).alias("_x"))
    return out.select(*keep, "_x.*")


def standing_scores(keys: DataFrame) -> DataFrame:
    """The last score of each user, driver, vendor and triple."""
    rows = keys.where(F.col("entity_kind").isin("user", "driver", "vendor", "uvd"))
    return rows.groupBy("entity_kind", "entity_key").agg(F.max_by("score", F.struct("event_ts", "order_id")).alias("score"))


def touched_orders(open_orders: DataFrame, standing: DataFrame, new_scores: DataFrame, delta: float = D.ELEVATION_DELTA) -> DataFrame:
    """order_id of open orders (exploded keys) that share a key whose score moved by delta or more."""
    moved = new_scores.select("entity_key", F.col("score").alias("_new")).join(standing.select("entity_key", F.col("score").alias("_old")), "entity_key", "left")
    moved = moved.where(F.abs(F.col("_new") - F.coalesce("_old", F.lit(0.0))) >= delta).select("entity_key")
    return open_orders.join(moved, "entity_key", "left_semi").select("order_id").distinct()


def archive_rows(snaps: DataFrame) -> DataFrame:
    """Flat log rows with JSON columns."""
    return snaps.select("order_id", F.col("event_ts").alias("ts"), F.to_date("event_ts").alias("day"), "tier", F.round("decision_score", 6).alias("decision_score"), "final_effect", "final_challenge", F.to_json("reason_codes").alias("reason_codes_json"), F.to_json("evidence_pack.evidence").alias("evidence_json"))


def archive_append(snaps: DataFrame, path: str) -> None:
    archive_rows(snaps).write.mode("append").partitionBy("day").parquet(path)


def archive_lookup(archive: DataFrame, order_id, n: int = 20) -> DataFrame:
    return archive.where(F.col("order_id") == order_id).orderBy(F.col("ts").desc()).limit(n)


def archive_recent(archive: DataFrame, n: int = 50) -> DataFrame:
    return archive.orderBy(F.col("ts").desc(), F.col("order_id").desc()).limit(n)


def latest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in the given order."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_k = 1").drop("_k")
