"""Training labels: dispositions, proxies, votes, discovery from edges, anomalies and self-training, caps, weights."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions import defaults as D
from claimlens.operators import graph
from claimlens.operators.ranks import quantiles, running
from claimlens.sources.tables import written

_TYPES = {c: "string" if c == "fraud_label_source" else "int" for c in D.LABEL_COLUMNS}


def ensure_labels(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast(t), F.lit("" if t == "string" else 0)) if c in df.columns else F.lit("" if t == "string" else 0).cast(t) for c, t in _TYPES.items()})


def latest_dispositions(dispositions: DataFrame, as_of=None) -> DataFrame:
    """order_id, outcome, disp_ts: the last per order; a row without time counts as the last. The column may be
    named disposition or outcome."""
    names = [c for c in ("disposition", "outcome") if c in dispositions.columns]
    out = dispositions.select("order_id", F.lower(F.trim(F.coalesce(*names))).alias("outcome"), F.col("disposition_ts").cast("timestamp").alias("disp_ts"))
    if as_of is not None:
        out = out.where(F.col("disp_ts").isNull() | (F.col("disp_ts") <= F.lit(as_of).cast("timestamp")))
    last = Window.partitionBy("order_id").orderBy(F.col("disp_ts").desc_nulls_first(), F.col("outcome").desc())
    return out.withColumn("_k", F.row_number().over(last)).where("_k = 1").drop("_k")


def apply_dispositions(orders: DataFrame, dispositions: DataFrame, outcomes: dict | None = None, lag_days: int = D.LAG_DAYS, as_of=None) -> DataFrame:
    """Label columns set by the latest disposition if its outcome is known and it came lag_days after the order
    or later; disposition_state says what happened: applied, lag, unknown or none."""
    outcomes = D.OUTCOMES if outcomes is None else outcomes
    out = ensure_labels(orders).join(latest_dispositions(dispositions, as_of), "order_id", "left")
    known = F.col("outcome").isin(*outcomes)
    ripe = F.lit(True) if lag_days <= 0 else F.coalesce(F.col("disp_ts") >= F.col("event_ts") + F.expr(f"INTERVAL {lag_days} DAYS"), F.lit(False))
    state = F.when(F.col("outcome").isNull(), "none").when(~known, "unknown").when(~ripe, "lag").otherwise("applied")
    out = out.withColumn("disposition_state", state)

    def patch(i: int, c: str) -> Column:
        value = reduce(lambda rest, x: F.when(F.col("outcome") == x[0], F.lit(x[1][i]).cast(_TYPES[c])).otherwise(rest), outcomes.items(), F.lit(None).cast(_TYPES[c]))
        return F.when(F.col("disposition_state") == "applied", value).otherwise(F.col(c))

    return out.withColumns({c: patch(i, c) for i, c in enumerate(D.LABEL_COLUMNS)}).drop("outcome", "disp_ts")


def proven() -> Column:
    return (F.lower("fraud_label_source") == "proven") | (F.col("strong_fraud_label") >= 1)


def proxy_fraud_labels(df: DataFrame, rules: dict | None = None) -> DataFrame:
    """Proxy fraud where a device farm or integrity flags meet support; proven and discovery labels stay."""
    r = D.PROXY if rules is None else rules
    df = ensure_labels(df)
    c = lambda n: F.coalesce(F.col(n).cast("double"), F.lit(0.0)) if n in df.columns else F.lit(0.0)
    support = (c("uvd_cooccur") >= r["cooccur"]) & (c("user_refund_rate_30d") >= r["rate"]) & (c("user_orders_30d") >= r["orders"])
    farm = (c("device_cluster_size") >= r["cluster"]) & (c("accounts_per_device") >= r["accounts"]) & (c("uvd_refund_lift") >= r["lift"]) & (c("uvd_refund_share") >= r["share"]) & support
    flags = reduce(lambda a, b: a + b, [F.least(F.greatest(c(n), F.lit(0.0)), F.lit(1.0)) for n in ("is_emulator", "is_cloned_app", "is_gps_spoof", "customer_courier_same_device")])
    hit = (farm | (((c("device_risk_score") >= r["device_risk"]) | (flags >= r["flags"])) & support)) & ~proven() & (F.lower("fraud_label_source") != "discovery") & (F.col("fraud_label") < 1)
    source = F.when(proven(), "proven").when(hit, "proxy").otherwise(F.col("fraud_label_source"))
    label = F.when(proven() | hit, 1).otherwise(F.col("fraud_label"))
    return df.withColumns({"fraud_label": label, "fraud_label_source": source})


def default_voters(df: DataFrame) -> dict[str, Column]:
    """Voters give 1, 0 or null (abstain)."""
    has = lambda n: F.col(n).cast("double") if n in df.columns else F.lit(None).cast("double")
    vote = lambda value, yes: F.when(value.isNotNull(), yes.cast("int"))
    rate, edge, life = has("user_refund_rate_30d"), has("uv_edge_elevated"), has("user_lifetime_orders")
    accounts = F.coalesce(has("accounts_per_device"), has("device_cluster_size"))
    reason = F.trim(F.coalesce(F.col("claim_reason"), F.lit(""))) != "" if "claim_reason" in df.columns else F.lit(False)
    # Names of the votes
    return {"high_user_refund_rate": vote(rate, rate >= 0.35), "elevated_uv_edge": vote(edge, edge >= 0.5), "claim_thin_history": F.when(reason, vote(life, life <= 2)), "device_multi_account": vote(accounts, accounts >= 3)}


def weak_labels(df: DataFrame, voters: dict[str, Column] | None = None, mint_from: float = 0.75) -> DataFrame:
    """Majority of the votes (a tie abstains: -1), its confidence, and labels where it is positive; proven rows keep
    theirs, and a negative vote never clears a label."""
    df = ensure_labels(df)
    voters = default_voters(df) if voters is None else voters
    n = lambda v: reduce(lambda a, b: a + b, [F.coalesce((c == v).cast("int"), F.lit(0)) for c in voters.values()])
    df = df.withColumns({"_p": n(1), "_n": n(0), "weak_lf_votes": F.concat_ws(";", *[F.concat(F.lit(f"{k}="), c.cast("string")) for k, c in voters.items()])})
    p, m = F.col("_p"), F.col("_n")
    df = df.withColumns({"weak_label": F.when(p == m, -1).when(p > m, 1).otherwise(0), "weak_label_confidence": F.when(p == m, F.lit(0.0)).otherwise(F.greatest(p, m) / F.greatest(p + m, F.lit(1)))})
    mine = (F.lower("fraud_label_source") != "proven") & (F.col("weak_label") == 1)
    mint = mine & (F.col("fraud_label") == 0) & F.lower("fraud_label_source").isin("", "proxy", "discovery") & (F.col("weak_label_confidence") >= mint_from)
    return df.withColumns({"abuse_label_weak": (F.col("weak_label") == 1).cast("int"), "abuse_label": F.when(mine, F.greatest("abuse_label", F.lit(1))).otherwise(F.col("abuse_label")), "fraud_label": F.when(mint, 1).otherwise(F.col("fraud_label")), "fraud_label_source": F.when(mint, "discovery").otherwise(F.col("fraud_label_source"))}).drop("_p", "_n")


def discovered(df: DataFrame, hit: Column) -> DataFrame:
    """hit rows as weak abuse and discovered fraud."""
    return df.withColumns({"_hit": F.coalesce(hit, F.lit(False))}).withColumns({c: F.when(F.col("_hit"), 1).otherwise(F.col(c)) for c in ("abuse_label", "abuse_label_weak", "fraud_label")} | {"fraud_label_source": F.when(F.col("_hit"), "discovery").otherwise(F.col("fraud_label_source"))}).drop("_hit")


def mint_uv(orders: DataFrame, history: DataFrame, mode: str = "asof_daily", null_test: bool = False) -> DataFrame:
    """Discovery labels for orders on elevated edges that aren't protected; null_test: above the null as of the day."""
    df = ensure_labels(orders)
    up = graph.elevated_orders(df, history, mode, null_test).select(F.col("order_id").alias("_up")).distinct()
    out = df.join(up, df["order_id"] == up["_up"], "left")
    return discovered(out, F.col("_up").isNotNull() & ~proven()).drop("_up")


# Columns that an anomaly is looked for in.
ANOMALY_COLUMNS = ("device_cluster_size", "accounts_per_device", "uvd_refund_lift", "uvd_refund_share", "uvd_cooccur", "device_risk_score", "user_refund_rate_30d", "uv_edge_anomaly", "user_bipartite_anomaly", "uv_edge_lift", "uv_edge_elevated", "uv_mo_possible_collusion", "uv_mo_user_scatter", "is_cloned_app", "is_gps_spoof", "customer_courier_same_device")


def anomaly_scores(df: DataFrame, clip: float = 10.0) -> DataFrame:
    """unsupervised_anomaly_score: mean over the columns of |x - median| / (1.4826 MAD), each at most clip (MAD 0: 1)."""
    cols = [c for c in ANOMALY_COLUMNS if c in df.columns]
    x = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols}
    first = lambda q: q.select(*[F.col(c)[0].alias(c) for c in q.columns])
    mid = first(quantiles(df, {f"_m_{c}": x[c] for c in cols}, [0.5]))
    df = written(df.crossJoin(F.broadcast(mid)))
    mad = first(quantiles(df, {f"_d_{c}": F.abs(x[c] - F.col(f"_m_{c}")) for c in cols}, [0.5]))
    df = df.crossJoin(F.broadcast(mad))
    z = [F.least(F.abs(x[c] - F.col(f"_m_{c}")) / F.when(F.col(f"_d_{c}") == 0, F.lit(1.0)).otherwise(1.4826 * F.col(f"_d_{c}")), F.lit(clip)) for c in cols]
    return df.withColumn("unsupervised_anomaly_score", reduce(lambda a, b: a + b, z) / float(len(cols))).drop(*[f"_{k}_{c}" for c in cols for k in "md"])


def capped(df: DataFrame, candidate: Column, score: str, cap: Column) -> DataFrame:
    """`_pick`: the candidates of the highest scores (ties: the smaller order_id), as many as cap.

    Only candidates are ranked, in ranges of their order."""
    df = df.withColumn("_cand", F.coalesce(candidate, F.lit(False)))
    rank = running(df.where("_cand").select(F.col("order_id").alias("_oid"), F.col(score).alias("_by")), [], [F.col("_by").desc(), F.col("_oid")]).select("_oid", "_rank")
    size = df.agg(cap.cast("long").alias("_cap"))
    out = df.join(rank, df["order_id"] == rank["_oid"], "left").crossJoin(F.broadcast(size))
    return out.withColumn("_pick", F.coalesce(F.col("_rank") <= F.col("_cap"), F.lit(False))).drop("_oid", "_rank", "_cap", "_cand")


def with_anomaly_cut(features: DataFrame, pct: float = 0.95) -> DataFrame:
    """features with unsupervised_anomaly_score and `_cut`, its percentile over all rows."""
    df = written(anomaly_scores(written(features)))
    cut = quantiles(df, {"_cut": F.col("unsupervised_anomaly_score")}, [pct]).select(F.col("_cut")[0].alias("_cut"))
    return df.crossJoin(F.broadcast(cut))


def mint_robust_anomaly(features: DataFrame, pct: float = 0.95, max_frac: float = 0.02) -> DataFrame:
    """Discovery labels for the most anomalous rows: from the percentile on, unprotected, not proxies, capped."""
    return mint_from_cut(with_anomaly_cut(ensure_labels(features), pct), max_frac)


def mint_from_cut(df: DataFrame, max_frac: float = 0.02) -> DataFrame:
    """mint_robust_anomaly of rows with_anomaly_cut."""
    cand = (F.col("unsupervised_anomaly_score") >= F.col("_cut")) & ~proven() & ~F.lower("fraud_label_source").isin("proxy", "proven")
    out = capped(df, cand, "unsupervised_anomaly_score", F.floor(F.count("*") * max_frac))
    return discovered(out, F.col("_pick")).drop("_pick", "_cut")


def mint_self_train(scored: DataFrame, min_score: float = 80.0, max_frac: float = 0.01) -> DataFrame:
    df = ensure_labels(scored)
    cand = (F.col("fraud_label") < 1) & (F.col("abuse_label") < 1) & ~proven() & (F.col("decision_score") >= min_score)
    return discovered(capped(df, cand, "decision_score", F.floor(F.count("*") * max_frac)), F.col("_pick")).drop("_pick")


def cap_discovery(labelled: DataFrame, row_frac: float = 0.05, pos_frac: float = 0.35, score: str = "unsupervised_anomaly_score") -> DataFrame:
    """Discovery rows beyond the cap lose their marks: at most row_frac of the rows and pos_frac of fraud
    positives (where there are others), one at least."""
    disc = F.lower("fraud_label_source") == "discovery"
    rows = F.floor(F.count("*") * row_frac)
    others = F.count_if((F.col("fraud_label") >= 1) & ~disc)
    cap = F.when(others > 0, F.least(rows, F.floor(others * pos_frac / max(1e-9, 1 - pos_frac)))).otherwise(rows)
    cap = F.when(rows > 0, F.greatest(cap, F.lit(1))).otherwise(cap)
    df = capped(labelled, disc, score, cap)
    drop = disc & ~F.col("_pick")
    weak = drop & (F.col("abuse_label_weak") >= 1)
    return df.withColumns({"_drop": drop, "_weak": weak}).withColumns({"fraud_label": F.when(F.col("_drop"), 0).otherwise(F.col("fraud_label")), "fraud_label_source": F.when(F.col("_drop"), "").otherwise(F.col("fraud_label_source")), "abuse_label": F.when(F.col("_weak"), 0).otherwise(F.col("abuse_label")), "abuse_label_weak": F.when(F.col("_weak"), 0).otherwise(F.col("abuse_label_weak"))}).drop("_drop", "_weak", "_pick")


def with_sample_weights(labelled: DataFrame, head: str, cfg: dict | None = None, balance: bool = False) -> DataFrame:
    """weight_{head} by where the label comes from; balance: positives weigh as much as negatives."""
    w = D.WEIGHTS if cfg is None else cfg
    negative = F.when(F.col("weak_policy_negative") >= 1, w["weak_negative"]).otherwise(w["clean_negative"])
    if head == "fraud":
        src = F.lower("fraud_label_source")
        out = F.when(F.col("fraud_label") >= 1, F.when(src == "proven", w["fraud_proven"]).when(src == "discovery", w["fraud_discovery"]).otherwise(w["fraud_proxy"])).otherwise(negative)
    else:
        out = F.when(F.col("abuse_label") >= 1, F.when(F.col("abuse_label_weak") >= 1, w["abuse_weak"]).otherwise(w["abuse_positive"])).otherwise(negative)
    name = f"weight_{head}"
    df = labelled.withColumn(name, out)
    if balance:
        pos = F.col(f"{head}_label") >= 1
        sums = df.agg(F.sum(F.when(pos, F.col(name))).alias("_p"), F.sum(F.when(~pos, F.col(name))).alias("_n"))
        df = df.crossJoin(F.broadcast(sums)).withColumn(name, F.when(pos & (F.col("_p") > 0) & (F.col("_n") > 0), F.col(name) * F.col("_n") / F.col("_p")).otherwise(F.col(name))).drop("_p", "_n")
    return df


def with_stacker_target(labelled: DataFrame, least: int = 3) -> DataFrame:
    """stack_y: proven fraud or abuse, no proxy-only fraud; abuse or any fraud where that gives too few positives."""
    abuse, fraud = F.col("abuse_label") >= 1, F.col("fraud_label") >= 1
    df = labelled.withColumns({"_s": (proven() | abuse).cast("int"), "_f": (abuse | fraud).cast("int")})
    size = df.agg(F.sum("_s").alias("_pos"), F.count("*").alias("_all"))
    enough = (F.col("_pos") >= least) & (F.col("_pos") < F.col("_all"))
    return df.crossJoin(F.broadcast(size)).withColumn("stack_y", F.when(enough, F.col("_s")).otherwise(F.col("_f"))).drop("_s", "_f", "_pos", "_all")


def proven_count(orders: DataFrame, dispositions: DataFrame) -> DataFrame:
    """One row: orders that a disposition or a label proves."""
    hard = [k for k, v in D.OUTCOMES.items() if v[3] == "proven"]
    name = "disposition" if "disposition" in dispositions.columns else "outcome"
    a = dispositions.where(F.lower(F.trim(name)).isin(*hard)).select("order_id")
    b = ensure_labels(orders).where(proven()).select("order_id")
    return a.unionByName(b).agg(F.count_distinct("order_id").alias("n_proven"))


def require_proven(orders: DataFrame, least: int) -> None:
    n = ensure_labels(orders).where(proven()).count()
    if n < least:
        raise ValueError(f"{n} proven labels, {least} asked for")


def load_training_orders(orders: DataFrame | None, dispositions: DataFrame | None = None, sdk: DataFrame | None = None, labelled: DataFrame | None = None, enriched: DataFrame | None = None) -> tuple[DataFrame, str]:
    """Training orders and where they come from: labelled orders as they are if there are any ('labelled'), else raw orders
    with the dispositions ('orders'), else orders that hold the SDK's columns ('enriched', without a further overlay). SDK
    events are laid over the first two."""
    from claimlens.functions.signals import apply_sdk

    if labelled is not None:
        out, source = ensure_labels(labelled), "labelled"
    elif orders is not None:
        out, source = ensure_labels(orders) if dispositions is None else apply_dispositions(orders, dispositions), "orders"
    elif enriched is not None:
        return ensure_labels(enriched), "enriched"
    else:
        raise ValueError("no orders are given")
    return (out if sdk is None else apply_sdk(out, sdk)), source


def training_rates(orders: DataFrame) -> DataFrame:
    """One row: orders, those proven, and the shares of proven labels and of weak policy negatives."""
    sure = (F.lower("fraud_label_source") == "proven").cast("double")
    weak = (F.coalesce(F.col("weak_policy_negative").cast("double"), F.lit(0.0)) >= 1).cast("double")
    return orders.agg(F.count("*").alias("n"), F.coalesce(F.sum(sure).cast("long"), F.lit(0)).alias("n_proven"), F.avg(sure).alias("proven_rate"), F.avg(weak).alias("weak_policy_negative_rate"))


def time_split(orders: DataFrame, holdout_days: float = 7.0, min_train: int = 20, min_test: int = 10, frac: float = 0.2) -> tuple[DataFrame, DataFrame, dict]:
    """Train and test by event_ts: the last holdout_days; the last part of a shorter span; the last rows by time
    rank where a side would be too small; by position without times."""
    t = F.unix_micros("event_ts")
    first, last, n, valid = orders.agg(F.min(t), F.max(t), F.count("*"), F.count(t)).first()
    if valid < min_train + min_test:
        ranked = running(orders, [], [F.col("order_id")], name="_k")
        cut = max(n // 2, 1)
        return ranked.where(F.col("_k") <= cut).drop("_k"), ranked.where(F.col("_k") > cut).drop("_k"), {"mode": "positional", "temporal_ok": False}
    hold = int(holdout_days * 86_400_000_000)
    adaptive = last - first <= hold
    if adaptive:
        hold = max(int((last - first) * frac), 3_600_000_000)
    cut = last - hold
    n_train, n_test = orders.agg(F.count_if(t < cut), F.count_if(t >= cut)).first()
    if n_train < min_train or n_test < min_test:
        k = max(min_test, round(valid * frac))
        k = min(k, valid - min_train) if valid > min_train else max(1, valid // 5)
        # the k-th latest time; exact, as the smallest of the k latest
        cut = orders.select(t.alias("_t")).where("_t is not null").orderBy(F.col("_t").desc()).limit(k).agg(F.min("_t")).first()[0]
        adaptive = True
    return orders.where(t < cut), orders.where(t >= cut), {"mode": "time_adaptive" if adaptive else "time", "temporal_ok": not adaptive, "cut": cut}


def stratified_sample(labelled: DataFrame, n: int, seed: int = 42, oversample: float = 2.0, cap: float = 0.5) -> DataFrame:
    """n rows with labelled ones taken up to twice as often, at most half of the sample; by md5 order."""
    minority = (F.col("abuse_label") >= 1) | (F.col("fraud_label") >= 1)
    total, few = labelled.agg(F.count("*"), F.count_if(minority)).first()
    if n <= 0 or total <= n:
        return labelled
    share = min(cap, max(few / total * oversample, few / total))
    n_few = min(few, max(1, round(n * share))) if few else 0
    n_rest = min(n - n_few, total - few)
    n_few = n - n_rest
    # a hash threshold first, so that only a small surplus is ranked
    picked = []
    for cond, want, size in ((minority, n_few, few), (~minority, n_rest, total - few)):
        if want > 0:
            picked.append(labelled.where(cond).orderBy(F.md5(F.concat(F.col("order_id").cast("string"), F.lit(f"|{seed}"))), "order_id").limit(want))
    return reduce(lambda a, b: a.unionByName(b), picked)


def random_cap(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    return df.orderBy(F.md5(F.concat(F.col("order_id").cast("string"), F.lit(f"|{seed}"))), "order_id").limit(n)


def lookback(history: DataFrame, days: int, end=None) -> DataFrame:
    """History rows of the last days up to end (else up to its latest row)."""
    if end is not None:
        last = F.lit(end).cast("timestamp")
        return history.where((F.col("event_ts") <= last) & (F.col("event_ts") >= last - F.expr(f"INTERVAL {days} DAYS")))
    last = history.agg(F.max("event_ts").alias("_last"))
    return history.crossJoin(F.broadcast(last)).where(F.col("event_ts") >= F.col("_last") - F.expr(f"INTERVAL {days} DAYS")).drop("_last")


def prune_history(history: DataFrame, sampled: DataFrame, devices: DataFrame) -> DataFrame:
    """History of the sampled orders' users and of users of the same devices. Changes vendor and driver features,
    so it is off unless asked for."""
    mine = sampled.select("user_id").distinct()
    near = devices.join(devices.join(mine, "user_id", "left_semi").select("device_id").distinct(), "device_id", "left_semi").select("user_id")
    return history.join(mine.unionByName(near).distinct(), "user_id", "left_semi")


def training_frame(orders: DataFrame, history: DataFrame, devices: DataFrame, users: DataFrame | None, max_rows: int = 5000, days: int = 180, seed: int = 42, prune: bool = False) -> DataFrame:
    """A sample of labelled orders with the serving features over the recent history."""
    from claimlens.operators.pit import order_features

    some = stratified_sample(ensure_labels(orders), max_rows, seed)
    recent = lookback(history, days)
    if prune:
        recent = prune_history(recent, some, devices)
    return order_features(some, recent, devices, users).join(some.select("order_id", *D.LABEL_COLUMNS), "order_id")


HARD = ("investigator_confirmed_fraud", "chargeback_lost", "bank_dispute_lost", "manual_denied_fraud")


def review_sample(dispositions: DataFrame, n: int = 50, seed: int = 42) -> DataFrame:
    """Half hard outcomes, the rest soft ones, by md5 order; marked pending_review."""
    rows = dispositions.withColumn("_hard", F.col("disposition").isin(*HARD))
    tag = [F.md5(F.concat(F.col("order_id").cast("string"), F.lit("|"), "disposition", F.lit(f"|{seed}"))), F.col("order_id")]
    n_hard = min(rows.where("_hard").count(), max(1, n // 2))
    hard, soft = rows.where("_hard").orderBy(*tag).limit(n_hard), rows.where("not _hard").orderBy(*tag).limit(n - n_hard)
    return hard.unionByName(soft).drop("_hard").withColumn("qa_status", F.lit("pending_review"))
