"""Thresholds, ladders, calibration, drift and gates as grouped aggregates."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions import defaults as D
from claimlens.operators.ranks import quantiles


def threshold_sweep(scored: DataFrame, score: str, label: str, by: list[str] = (), amount: str | None = None, digits: int = 4) -> DataFrame:
    """Per distinct score (rounded, so their number is bounded): flagged rows, true and false positives from it upwards,
    with recall, precision, false-positive rate and mean amount of false positives."""
    key = list(by)
    money = F.when(F.col(label) < 1, F.col(amount)).otherwise(0) if amount else F.lit(0)
    steps = scored.groupBy(*key, F.round(score, digits).alias("score")).agg(F.count("*").alias("_n"), F.sum(F.col(label).cast("long")).alias("_p"), F.sum(money).alias("_m"))
    up = Window.partitionBy(*(key or [F.lit(1)])).orderBy(F.col("score").desc())
    whole = Window.partitionBy(*(key or [F.lit(1)]))
    out = steps.select(*key, "score", F.sum("_n").over(up).alias("n_pred"), F.sum("_p").over(up).alias("tp"), F.sum("_m").over(up).alias("fp_amount"), F.sum("_n").over(whole).alias("n"), F.sum("_p").over(whole).alias("n_pos"))
    fp = F.col("n_pred") - F.col("tp")
    return out.withColumns({"fp": fp, "recall": F.col("tp") / F.nullif("n_pos", F.lit(0)), "precision": F.col("tp") / F.col("n_pred"), "fp_rate": F.coalesce(fp / F.nullif(F.col("n") - F.col("n_pos"), F.lit(0)), F.lit(0.0)), "fp_amount_mean": F.coalesce(F.col("fp_amount") / F.nullif(fp, F.lit(0)), F.lit(0.0))})


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    p, zz = k / n, z * z
    centre = (p + zz / (2.0 * n)) / (1.0 + zz / n)
    margin = z * F.sqrt(p * (1.0 - p) / n + zz / (4.0 * n * n)) / (1.0 + zz / n)
    return F.greatest(F.lit(0.0), centre - margin), F.least(F.lit(1.0), centre + margin)


def recommend_ladders(scored: DataFrame, score: str, label: str, by: list[str] = (), amount: str | None = None, target: float = 0.98, min_precision: float = 0.15, max_fp_rate: float | None = None, max_fp_mean: float | None = None,
                      defaults=D.LADDER, min_n: int = 20, min_pos: int = 3, min_ci: int = 10) -> DataFrame:
    """Per slice: soft (the highest cut that keeps the recall within the cost limits; null if there is none), hold and deny by
    recall, made monotone; recall, precision, false-positive rate and Wilson bounds at soft; thin, ok and promote flags."""
    key = list(by)
    sweep = threshold_sweep(scored, score, label, key, amount)
    fits = (F.col("recall") + 1e-12 >= target) & (F.col("precision") + 1e-12 >= min_precision)
    if max_fp_rate is not None:
        fits &= F.col("fp_rate") <= max_fp_rate + 1e-12
    if max_fp_mean is not None:
        fits &= F.col("fp_amount_mean") <= max_fp_mean + 1e-12
    # cuts by a window over a slice's score steps, so that the steps are made once and joined with nothing
    whole = Window.partitionBy(*(key or [F.lit(1)]))
    reach = lambda r: F.max(F.when(F.col("recall") >= r, F.col("score"))).over(whole)
    rows = sweep.withColumns({"soft_cut": F.max(F.when(fits, F.col("score"))).over(whole), "_h": reach(max(0.85, target - 0.08)), "_d": reach(0.5)})
    rows = rows.withColumn("soft_friction", F.coalesce("soft_cut", "_h", F.lit(defaults[0])))
    rows = rows.withColumn("hold_review", F.greatest(F.coalesce("_h", F.lit(defaults[1])), "soft_friction"))
    rows = rows.withColumn("auto_deny", F.greatest(F.coalesce("_d", F.lit(defaults[2])), "hold_review")).where(F.col("score") >= F.col("soft_friction"))
    cuts = [*key, "n", "n_pos", "soft_cut", "soft_friction", "hold_review", "auto_deny"]
    first = rows.groupBy(*cuts).agg(F.min_by(F.struct("n_pred", "tp", "recall", "precision", "fp_rate"), "score").alias("_at"))
    out = first.select(*cuts, "_at.*")
    low, high = wilson(F.col("tp"), F.col("n_pred"))
    out = out.withColumns({"wilson_lo": low, "wilson_hi": high, "thin": (F.col("n") < min_n) | (F.col("n_pos") < min_pos), "soft_floor_binds": F.col("soft_friction") < 10.0})
    ok = F.col("soft_cut").isNotNull() & ~F.col("soft_floor_binds") & (F.col("n_pred") >= min_ci) & (F.col("wilson_lo") + 1e-12 >= min_precision)
    return out.withColumn("promote", ok & ~F.col("thin"))


def overlays(ladders: DataFrame) -> DataFrame:
    return ladders.where("promote").select("market", "vertical", *[F.round(c, 2).alias(c) for c in ("soft_friction", "hold_review", "auto_deny")])


def rates_at(df: DataFrame, score: str, label: str, cut: float, by: list[str] = ()) -> DataFrame:
    """Precision, recall and false-positive rate at a cut; null where the denominator is 0."""
    flag, pos = F.col(score) >= cut, F.col(label) >= 1
    n = F.count_if
    return df.groupBy(*by).agg((n(flag & pos) / F.nullif(n(flag), F.lit(0))).alias("precision"), (n(flag & pos) / F.nullif(n(pos), F.lit(0))).alias("recall"), (n(flag & ~pos) / F.nullif(n(~pos), F.lit(0))).alias("fp_rate"))


def or_head_recall(df: DataFrame, abuse_cut: float, fraud_cut: float) -> DataFrame:
    pos = (F.col("abuse_label") >= 1) | (F.col("fraud_label") >= 1)
    hit = (F.col("abuse_score") >= abuse_cut) | (F.col("fraud_score") >= fraud_cut)
    return df.agg((F.count_if(pos & hit) / F.nullif(F.count_if(pos), F.lit(0))).alias("pattern_recall"))


def brier(df: DataFrame, score: str, label: str, by: list[str] = ()) -> DataFrame:
    e = F.col(score) / 100.0 - F.col(label)
    return df.groupBy(*by).agg(F.avg(e * e).alias("brier"))


def ece(df: DataFrame, score: str, label: str, bins: int = 10, binning: str = "fixed", min_pos: int = 0, min_bin: int = 0) -> DataFrame:
    """One row: ece, occupied bins, n, positives, usable. Fixed: equal widths; adaptive: between distinct quantiles."""
    df = df.select((F.col(score) / 100.0).alias("_s"), F.col(label).cast("double").alias("_y"))
    if binning == "fixed":
        df = df.withColumn("_b", F.least(F.floor(F.col("_s") * bins), F.lit(bins - 1)))
    else:
        df = with_bins(df, quantile_edges(df, "_s", bins), "_s")
    per = df.groupBy("_b").agg(F.count("*").alias("_n"), F.avg("_s").alias("_c"), F.avg("_y").alias("_a"), F.sum("_y").alias("_p"))
    out = per.agg((F.sum(F.col("_n") * F.abs(F.col("_a") - F.col("_c"))) / F.sum("_n")).alias("ece"), F.count("*").alias("bins"), F.sum("_n").alias("n"), F.sum("_p").cast("long").alias("n_pos"), F.min("_n").alias("_least"))
    usable = (F.col("n_pos") >= min_pos) & ((F.lit(min_bin) == 0) | ((F.col("_least") >= min_bin) & (F.col("bins") >= 2)))
    return out.withColumn("usable", usable).drop("_least")


def quantile_edges(df: DataFrame, c: str, bins: int) -> DataFrame:
    """One row: the distinct quantiles at 0, 1/bins, ..., 1."""
    return quantiles(df, {"_edges": F.col(c)}, [i / bins for i in range(bins + 1)]).select(F.array_sort(F.array_distinct("_edges")).alias("_edges"))


def with_bins(df: DataFrame, edges: DataFrame, c: str) -> DataFrame:
    """_b: the range between edges that c is in, the last one closed; null outside."""
    df = df.crossJoin(F.broadcast(edges))
    at = F.size(F.filter("_edges", lambda e: e <= F.col(c))) - 1
    last = F.size("_edges") - 2
    return df.withColumn("_b", F.when((F.col(c) >= F.element_at("_edges", 1)) & (F.col(c) <= F.element_at("_edges", -1)), F.greatest(F.least(at, last), F.lit(0)))).drop("_edges")


def psi(expected: DataFrame, actual: DataFrame, c: str, bins: int = 10) -> DataFrame:
    """One row: the population stability index over the expected rows' quantile bins; values outside are dropped."""
    edges = quantile_edges(expected, c, bins)
    count = lambda df, name: with_bins(df, edges, c).where("_b is not null").groupBy("_b").agg(F.count("*").alias(name))
    both = count(expected, "_e").join(count(actual, "_a"), "_b", "full").select(*[(F.coalesce(k, F.lit(0)) + 1e-6).alias(k) for k in ("_e", "_a")])
    total = both.agg(F.sum("_e").alias("_te"), F.sum("_a").alias("_ta"))
    both = both.crossJoin(F.broadcast(total)).select((F.col("_e") / F.col("_te")).alias("e"), (F.col("_a") / F.col("_ta")).alias("a"))
    return both.agg(F.sum((F.col("a") - F.col("e")) * F.log(F.col("a") / F.col("e"))).alias("psi"))


def ranking(df: DataFrame, score: str, label: str, by: list[str] = (), digits: int = 6) -> DataFrame:
    """ROC AUC (rank sum, ties halved) and average precision per slice; null where a class is missing."""
    key = list(by)
    return ranked_steps(df.groupBy(*key, F.round(score, digits).alias("_s")).agg(F.count("*").alias("_n"), F.sum(F.col(label).cast("long")).alias("_p")), key)


def ranked_steps(steps: DataFrame, key: list[str]) -> DataFrame:
    """The same from rows (_n) and positives (_p) per score step (_s)."""
    part = key or [F.lit(1)]
    up, down = Window.partitionBy(*part).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*part).orderBy(F.col("_s").desc())
    steps = steps.withColumns({"_before": F.coalesce(F.sum("_n").over(up), F.lit(0)), "_tn": F.sum("_n").over(down), "_tp": F.sum("_p").over(down)})
    ranks = F.sum(F.col("_p") * (F.col("_before") + (F.col("_n") + 1) / 2.0))
    n, p = F.sum("_n"), F.sum("_p")
    ap = F.sum(F.col("_p") * F.col("_tp") / F.col("_tn")) / F.nullif(p, F.lit(0))
    return steps.groupBy(*key).agg(((ranks - p * (p + 1) / 2.0) / F.nullif(p * (n - p), F.lit(0))).alias("auc"), ap.alias("average_precision"))


#: Numbers are drawn below this prime, by squaring modulo it (whole numbers only, so that every engine draws the same).
PRIME = 2_147_483_647


def draw(key: Column, turn: Column, seed: int = 0) -> Column:
    """A number in [0, PRIME) for a whole-numbered key and turn: neighbours in either have nothing to do with each other."""
    k = F.pmod(key.cast("long"), F.lit(PRIME))
    x = F.pmod(k * 48271 + turn * 69621 + F.lit(seed + 12345), F.lit(PRIME))
    x = F.pmod(x * x + turn * 40692 + k, F.lit(PRIME))
    return F.pmod(x * x + 1, F.lit(PRIME))


def poisson_steps(most: int = 11) -> list[float]:
    """Where the distribution of Poisson(1) steps up: a uniform number is worth as many as it reaches."""
    out, term, total = [], math.exp(-1), 0.0
    for k in range(1, most + 1):
        total += term
        out.append(total)
        term /= k
    return out


def bootstrap_precision(df: DataFrame, score: str, label: str, cut: float, rounds: int = 400, seed: int = 0) -> DataFrame:
    """One row: percentile bounds of the precision over `rounds` Poisson resamples of the flagged rows.

    Each row weighs Poisson(1) in each round, by a number drawn from its order_id and the round, so reruns agree; weights
    are summed by round before anything is shuffled."""
    u = draw(F.col("order_id"), F.col("_r"), seed) / float(PRIME)
    steps = reduce(lambda a, b: a + b, [(u >= x).cast("int") for x in poisson_steps()])
    flagged = df.where(F.col(score) >= cut).select("order_id", (F.col(label) >= 1).cast("int").alias("_y"))
    weights = flagged.select("order_id", "_y", F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("_r")).withColumn("_w", steps)
    per = weights.groupBy("_r").agg((F.sum(F.col("_y") * F.col("_w")) / F.nullif(F.sum("_w"), F.lit(0))).alias("_p"))
    return per.agg(F.percentile("_p", F.lit(0.025)).alias("lo"), F.percentile("_p", F.lit(0.975)).alias("hi"))


def shadow_precision(decided: DataFrame, labelled: DataFrame) -> DataFrame:
    """Per shadow effect: orders on which a rule in shadow mode would have acted, and the share of them that a label confirms."""
    hit = ((F.col("abuse_label") >= 1) | (F.col("fraud_label") >= 1)).cast("int")
    rows = decided.where("shadow_effect is not null").select("order_id", "shadow_effect").join(labelled.select("order_id", hit.alias("_y")), "order_id", "left")
    return rows.groupBy("shadow_effect").agg(F.count("*").alias("n"), F.coalesce(F.sum("_y"), F.lit(0)).alias("n_true"), F.avg(F.coalesce("_y", F.lit(0))).alias("precision"))


def long_form(row: DataFrame, names: list[str]) -> DataFrame:
    """metric, value of one row's columns; those that are null are left out."""
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in names])).alias("_x")).select("_x.*").where("value is not null")


def oot_evaluation(holdout: DataFrame, score: str = "decision_score", soft: float = D.LADDER[0], floors: dict | None = None) -> DataFrame:
    """Scored and labelled rows after the time split against the floors of an out-of-time pack: metric, value, floor,
    ok. Values that can't be computed fail."""
    floors = D.OOT_FLOORS if floors is None else floors
    df = holdout.withColumns({"_proven": (F.lower("fraud_label_source") == "proven").cast("int"), "_y": ((F.col("abuse_label") >= 1) | (F.col("fraud_label") >= 1)).cast("int")})
    row = df.agg(F.count("*").alias("holdout_n"), F.sum("_proven").alias("proven_positives"))
    row = row.crossJoin(ranking(df, score, "_proven").select(F.col("average_precision").alias("fraud_proven_average_precision")))
    row = row.crossJoin(rates_at(df, score, "_proven", soft).select(F.col("precision").alias("fraud_proven_precision_at_soft"))).crossJoin(ece(df, score, "_y").select(F.col("ece").alias("decision_ece")))
    checks = [F.struct(F.lit(k[4:]).alias("metric"), F.col(k[4:]).cast("double").alias("value"), F.lit(float(v)).alias("floor"), (F.col(k[4:]) >= v if k.startswith("min_") else F.col(k[4:]) <= v).alias("ok")) for k, v in floors.items()]
    return row.select(F.explode(F.array(*checks)).alias("_x")).select("_x.*").withColumn("ok", F.coalesce("ok", F.lit(False)))


def backtest_report(train: DataFrame, test: DataFrame, temporal_ok: bool, score: str = "decision_score", label: str = "y") -> DataFrame:
    """Metrics of scored and labelled rows after the time split as a long table (metric, value), with the ladder that the
    training rows recommend, the monitoring gate and promote_ok."""
    row = test.agg(F.count("*").alias("n_test")).crossJoin(train.agg(F.count("*").alias("n_train")))
    row = row.crossJoin(brier(test, score, label).select(F.col("brier").alias("decision_brier"))).crossJoin(ece(test, score, label).select(F.col("ece").alias("decision_ece")))
    row = row.crossJoin(ranking(test, score, label)).crossJoin(rates_at(test, score, label, D.LADDER[0])).crossJoin(or_head_recall(test, D.LADDER[0], 30.0)).crossJoin(psi(train, test, score).select(F.col("psi").alias("psi_train_test")))
    row = row.crossJoin(recommend_ladders(train, score, label).select("soft_friction", "hold_review", "auto_deny", F.col("promote").cast("int").alias("ladder_ok")))
    over = [F.coalesce(F.col(k).cast("double") > v, F.lit(True)).cast("int") for k, v in D.CEILINGS.items() if k in ("decision_ece", "decision_brier", "psi_train_test")]
    row = row.withColumns({"temporal_ok": F.lit(int(temporal_ok)), "gate_breaches": total(over)})
    row = row.withColumn("promote_ok", ((F.col("ladder_ok") == 1) & (F.col("gate_breaches") == 0) & F.lit(temporal_ok)).cast("int"))
    return long_form(row, row.columns)


def monitoring_gate(metrics: DataFrame, ceilings: dict | None = None, now=None, as_of: Column | None = None, max_hours: float = D.MAX_SNAPSHOT_HOURS) -> DataFrame:
    """metrics: one row. One row per breach: metric, value, ceiling, reason; a metric that is missing fails."""
    ceilings = D.CEILINGS if ceilings is None else ceilings
    checks = [F.struct(F.lit(k).alias("metric"), (F.col(k).cast("double") if k in metrics.columns else F.lit(None).cast("double")).alias("value"), F.lit(float(v)).alias("ceiling")) for k, v in ceilings.items()]
    if now is not None and as_of is not None:
        hours = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(as_of)) / 3.6e9
        checks.append(F.struct(F.lit("ops_snapshot_age_hours").alias("metric"), hours.alias("value"), F.lit(float(max_hours)).alias("ceiling")))
    rows = metrics.select(F.explode(F.array(*checks)).alias("_x")).select("_x.*")
    return rows.where("value is null or value > ceiling").withColumn("reason", F.when(F.col("value").isNull(), "missing").otherwise("above"))


def validate_pack(orders: DataFrame, dispositions: DataFrame, floors: dict | None = None) -> DataFrame:
    """One row: size and proven orders against the floors."""
    from claimlens.operators.labels import proven_count

    f = D.PACK_FLOORS if floors is None else floors
    out = orders.agg(F.count("*").alias("n_orders")).crossJoin(proven_count(orders, dispositions))
    return out.withColumn("ok", (F.col("n_orders") >= f["min_pack_n"]) & (F.col("n_proven") >= f["min_proven"]))


def daily_refund_series(history: DataFrame, min_orders: int = 5) -> DataFrame:
    """segment, day, n and refund rate; where is_refund is missing a claim reason stands for it."""
    refund = (F.col("is_refund") > 0) if "is_refund" in history.columns else (F.length(F.coalesce("claim_reason", F.lit(""))) > 0)
    segment = F.concat_ws("|", F.upper("market"), F.lower("vertical"))
    out = history.groupBy(segment.alias("segment"), F.to_date("event_ts").alias("day")).agg(F.count("*").alias("n"), F.avg(refund.cast("double")).alias("refund_rate"))
    return out.where(F.col("n") >= min_orders)


def segment_anomalies(series: DataFrame, baseline: int = 14, gap: int = 3, z: float = 3.0) -> DataFrame:
    """Per segment with enough days: the last day's rate against the first `baseline` days of the series."""
    seq = Window.partitionBy("segment").orderBy("day")
    rows = series.withColumns({"_k": F.row_number().over(seq), "_last": F.row_number().over(Window.partitionBy("segment").orderBy(F.col("day").desc()))})
    early = F.when(F.col("_k") <= baseline, F.col("refund_rate"))
    out = rows.groupBy("segment").agg(F.count("*").alias("n_days"), F.avg(early).alias("baseline_mean"), F.stddev_pop(early).alias("baseline_std"), F.max(F.when(F.col("_last") == 1, F.col("refund_rate"))).alias("test_rate"), F.max("day").alias("test_day"))
    out = out.where(F.col("n_days") >= baseline + gap + 1)
    score = (F.col("test_rate") - F.col("baseline_mean")) / F.greatest("baseline_std", F.lit(1e-9))
    return out.withColumns({"z": score, "flagged": score >= z})


def proposals(anomalies: DataFrame) -> DataFrame:
    """Shadow-only proposals for flagged segments."""
    part = F.split("segment", r"\|")
    return anomalies.where("flagged").select(F.lit("decision_threshold_overlay").alias("kind"), F.lit("shadow").alias("mode"), F.lit(False).alias("auto_enforce"), part[0].alias("market"), part[1].alias("vertical"), F.concat(F.lit("refund_rate z="), F.format_number("z", 2)).alias("reason"))


def source_metrics(df: DataFrame, score: str, digits: int = 4) -> DataFrame:
    """Ranking quality of each fraud label source against the negatives. Negatives are counted by score step before
    they meet the sources, of which there are a handful."""
    steps = df.groupBy(F.when(F.col("fraud_label") >= 1, F.col("fraud_label_source")).alias("source"), F.round(score, digits).alias("_s"), (F.col("fraud_label") >= 1).alias("_y")).agg(F.count("*").alias("_n"))
    pos = steps.where("_y").select("source", "_s", "_n", F.col("_n").alias("_p"))
    neg = steps.where("not _y").select("_s", "_n").crossJoin(F.broadcast(pos.select("source").distinct()))
    rows = pos.unionByName(neg.select("source", "_s", "_n", F.lit(0).cast("long").alias("_p")))
    return ranked_steps(rows.groupBy("source", "_s").agg(F.sum("_n").alias("_n"), F.sum("_p").alias("_p")), ["source"])


def slice_metrics(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per market and vertical, with totals: rows, positives, thin flag, recall and precision at the soft cut."""
    flag, pos = F.col(score) >= D.LADDER[0], F.col(label) >= 1
    n = F.count_if
    out = df.rollup("market", "vertical").agg(F.count("*").alias("n"), n(pos).alias("n_pos"), (n(flag & pos) / F.nullif(n(pos), F.lit(0))).alias("recall"), (n(flag & pos) / F.nullif(n(flag), F.lit(0))).alias("precision"))
    return out.withColumns({"market": F.coalesce("market", F.lit("ALL")), "vertical": F.coalesce("vertical", F.lit("all")), "thin": (F.col("n") < 20) | (F.col("n_pos") < 3)})


def ops_snapshot(raw: DataFrame) -> DataFrame:
    """The newest snapshot row: metrics nested or flat, numbers where they can be cast."""
    have, nested = set(raw.columns), "metrics" in raw.columns
    fields = {f.name for f in raw.schema["metrics"].dataType.fields} if nested else set()
    names = ("hold_rate", "live_override_rate", "shadow_override_rate", "refund_grant_rate", "refund_dollar_per_order", "cs_queue_depth")
    pick = lambda k: F.coalesce(*[c for c in (F.col(f"metrics.{k}").try_cast("double") if k in fields else None, F.col(k).try_cast("double") if k in have else None) if c is not None], F.lit(None).cast("double"))
    rows = raw.select(F.to_timestamp("as_of").alias("as_of"), *[pick(k).alias(k) for k in names])
    return rows.orderBy(F.col("as_of").desc_nulls_last()).limit(1)


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)
