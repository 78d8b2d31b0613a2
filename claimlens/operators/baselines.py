"""Rolling behaviour baselines per entity key, cohorts, and the gate that warps thresholds.

State after each event comes from windows over the score log, ordered by (event_ts, order_id): last events within
a number of days, streaks by islands, the sticky clean flag as the last earned or revoked mark."""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions import defaults as D
from claimlens.operators import scoring
from claimlens.operators.ranks import running

KEY = ["entity_key", "market", "vertical"]
DAY = 86_400_000_000


def settled_observations(keys: DataFrame, cfg: dict = D.BASELINE) -> DataFrame:
    """Settled orders x keys, one row per order and key."""
    return keys.where(F.lower("status").isin(*cfg["settled"])).dropDuplicates(["order_id", *KEY])


def observations_of(log: DataFrame, cfg: dict = D.BASELINE) -> DataFrame:
    """settled_observations of a log: orders are told apart before their keys are, which are eight times as many, and keys
    are compared only within orders that the log holds more than once."""
    rows = log.where(F.lower("status").isin(*cfg["settled"]))
    names = [k for k in dict.fromkeys(i for ids in scoring.KINDS.values() for i in ids)]
    here = F.struct("market", "vertical", *names)
    earlier = Window.partitionBy("order_id").orderBy("event_ts").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_earlier", F.collect_list(here).over(earlier))
    keys = scoring.entity_keys(rows, keep=("_earlier", *names))
    same = lambda x, ids: reduce(lambda a, b: a & b, [x[c].eqNullSafe(F.col(c)) for c in ("market", "vertical", *ids)])
    seen = reduce(lambda rest, k: F.when(F.col("entity_kind") == k[0], F.exists("_earlier", lambda x: same(x, k[1]))).otherwise(rest), scoring.KINDS.items(), F.lit(False))
    return keys.where((F.size("_earlier") == 0) | ~seen).drop("_earlier", *names)


def _nth(sorted_scores: Column, at: Column) -> Column:
    return F.element_at(sorted_scores, at.cast("int"))


def positional(a: Column) -> tuple[Column, Column]:
    """Positional p50 and p90 of a sorted array."""
    n = F.size(a)
    return _nth(a, F.floor(n / 2) + 1), _nth(a, F.greatest(F.lit(1), F.floor(n * 0.9)))


def mean_of(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a)


def _standing(rows: DataFrame, seq: Window, recent: Column, c: dict) -> DataFrame:
    """rows (`_t`, `_probe`) in the order of seq with the baseline after each of them; recent: the key's last events up to
    the row. Rows with `_probe` 1 leave all of it as it stands."""
    event = F.col("_probe") == 0
    only = lambda e: F.when(event, e)
    rows = rows.withColumn("_a", recent)
    rows = rows.withColumn("_a", only(F.transform(F.filter("_a", lambda x: x["_t"] >= F.col("_t") - c["days"] * DAY), lambda x: x["score"])))
    rows = rows.withColumn("_u", F.filter("_a", lambda s: s < F.col("under_threshold")))
    rows = rows.withColumns({"n_observations": F.size("_a"), "n_under": F.size("_u"), "_z": F.array_sort(F.when(F.size("_u") > 0, F.col("_u")).otherwise(F.col("_a"))), "_m": F.when(F.size("_u") > 0, F.col("_u")).otherwise(F.col("_a"))})
    p50, p90 = positional(F.col("_z"))
    rows = rows.withColumns({"under_rate": only(F.col("n_under") / F.col("n_observations")), "baseline_mean": only(mean_of(F.col("_m"))), "baseline_p50": only(p50), "baseline_p90": only(p90), "_under": only(F.col("score") < F.col("under_threshold"))})
    lift = F.col("score") / F.greatest("baseline_mean", F.lit(1e-6))
    up = (((F.col("score") - F.col("baseline_mean")) >= c["delta"]) | (lift >= c["lift"])) & ~F.col("_under")
    rows = rows.withColumns({"_up": up, "lift": lift, "abs_delta": F.col("score") - F.col("baseline_mean")})
    pair = F.col("entity_kind").isin("ud", "uv", "vd", "uvd") & (F.col("support") < c["pair_min"])
    mark = F.when(~pair & (F.col("n_observations") >= c["min_obs"]) & (F.col("under_rate") >= c["min_under_rate"]), 1).when(F.col("under_rate") < c["revoke"], 0)
    rows = rows.withColumn("_mark", only(mark))
    so_far = seq.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({f"_i{k}": F.sum(F.col(f"_{k}").cast("int")).over(so_far) for k in ("under", "up")})
    # a streak: how many so far, without those up to the last row that broke it
    for k, name in (("under", "under_streak"), ("up", "elevated_streak")):
        rows = rows.withColumn(name, F.col(f"_i{k}") - F.coalesce(F.last(F.when(~F.col(f"_{k}"), F.col(f"_i{k}")), True).over(so_far), F.lit(0)))
    return rows.withColumn("is_clean", F.coalesce(F.last("_mark", True).over(so_far), F.lit(0)) == 1).drop("_a", "_u", "_z", "_m", "_under", "_up", "_iunder", "_iup", "_mark")


def baseline_history(observations: DataFrame, cfg: dict = D.BASELINE) -> DataFrame:
    """One row per observation with the baseline after it."""
    rows = observations.withColumns({"_t": F.unix_micros("event_ts"), "under_threshold": under_threshold(cfg), "_probe": F.lit(0)})
    seq = Window.partitionBy(*KEY).orderBy("_t", "order_id")
    # rows up to this one, then those of the last days, then the last events: same-instant rows keep their order
    recent = F.collect_list(F.struct("_t", "score")).over(seq.rowsBetween(-(cfg["events"] - 1), Window.currentRow))
    return _standing(rows, seq, recent, cfg).drop("_t", "_probe")


def baselines_as_of(keys: DataFrame, observations: DataFrame, cfg: dict = D.BASELINE) -> DataFrame:
    """keys (exploded keys of orders, with whatever they carry) and the baseline of each as of the order: after its own
    observation, or after the last before it by event_ts and order_id. Keys without one are left out.

    Observations and asked keys go through the same windows, so the states of the log are neither kept nor looked up."""
    others = [c for c in keys.columns if c not in ("order_id", "event_ts", "entity_kind", "score_head", "score", "support", *KEY)]
    own = ["order_id", *KEY, "entity_kind", "score_head", "score", "support", F.unix_micros("event_ts").alias("_t")]
    known = observations.select(*own, F.lit(0).alias("_probe"))
    asked = keys.select(*own, F.lit(1).alias("_probe"), F.struct("event_ts", *others).alias("_row"))
    rows = known.unionByName(asked, allowMissingColumns=True).withColumn("under_threshold", under_threshold(cfg))
    upto = Window.partitionBy(*KEY).orderBy("_t", "order_id", "_probe").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the events of a key at even places, what is asked after them at odd ones: a range of places is one of events
    rows = rows.withColumn("_place", 2 * F.sum(1 - F.col("_probe")).over(upto) + F.col("_probe"))
    seq = Window.partitionBy(*KEY).orderBy("_place")
    recent = F.collect_list(F.when(F.col("_probe") == 0, F.struct("_t", "score"))).over(seq.rangeBetween(-2 * (cfg["events"] - 1), Window.currentRow))
    rows = _standing(rows, seq, recent, cfg)
    state = F.when(F.col("_probe") == 0, F.struct("baseline_mean", "under_rate"))
    rows = rows.withColumn("_state", F.last(state, True).over(seq.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    out = rows.where("_probe = 1 and _state.baseline_mean is not null")
    return out.select("order_id", "entity_kind", *KEY, "score_head", "score", "support", "_row.*", "_state.*", "is_clean", "elevated_streak")


def latest_baselines(history: DataFrame) -> DataFrame:
    """The standing baseline of each key; where is_clean holds: the clean ones."""
    return history.withColumn("_k", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.col("event_ts").desc(), F.col("order_id").desc()))).where("_k = 1").drop("_k")


def tenure_bucket(days: Column, cfg: dict = D.BASELINE) -> Column:
    return F.when(days < cfg["new_days"], "new").when(days < cfg["mid_days"], "mid").otherwise("mature")


COHORT = ["market", "vertical", "tenure_bucket", "score_head"]
#: Rows of a cohort that one window task takes, besides the overlap.
BLOCK = 20_000


def cohort_rows(scored: DataFrame, cfg: dict = D.BASELINE, settled: bool = True) -> DataFrame:
    """order_id, event_ts, cohort and score of each order and head; of settled orders only, unless told otherwise."""
    bucket = tenure_bucket(F.col("user_days_since_signup"), cfg)
    rows = scored.where(F.lower("status").isin(*cfg["settled"])) if settled else scored
    heads = F.explode(F.array(*[F.struct(F.lit(h).alias("score_head"), F.col(f"{h}_score").alias("score")) for h in ("abuse", "fraud")])).alias("_x")
    return rows.select("order_id", "event_ts", "market", "vertical", bucket.alias("tenure_bucket"), heads).select("order_id", "event_ts", "market", "vertical", "tenure_bucket", "_x.*")


def _last_events(back: int, keep: list[str]):
    """For blocks of a cohort (`_n`: how many scores come up to the row; `_probe`: 1 for rows that only ask; `_block` and
    `_own`): the columns to keep of the block's own rows, with size, mean, positional p50 and p90 of the last back + 1 scores.

    The sorted scores are kept from row to row: one goes in, one comes out."""

    def stats(block: pa.Table) -> pa.Table:
        block = block.sort_by([("_n", "ascending"), ("_probe", "ascending")])
        at, scored = block["_n"].to_numpy(), block["_probe"].to_numpy() == 0
        scores = block["score"].filter(pa.array(scored)).to_pylist()
        kept, size, p50, p90 = [], [], [], []
        # NaN sorts last, as in Spark
        sortable = [math.inf if s is not None and s != s else s for s in scores]
        for i, s in enumerate(sortable):
            if s is not None:
                insort(kept, s)
            if i > back and (gone := sortable[i - back - 1]) is not None:
                del kept[bisect_left(kept, gone)]
            n = len(kept)
            size.append(n)
            p50.append(kept[n // 2] if n else None)
            p90.append(kept[max(1, math.floor(n * 0.9)) - 1] if n else None)
        values, total = np.array([0.0 if s is None else s for s in scores]), np.zeros(len(scores))
        # from the oldest to the newest, so that sums are those of a loop
        for k in range(min(back, len(scores) - 1), -1, -1):
            total[k:] += values[: len(values) - k]
        n = np.array(size, dtype=np.int32)
        mean = np.divide(total, n, out=np.full(len(n), np.nan), where=n > 0)
        mine = np.flatnonzero(block["_own"].to_numpy() == block["_block"].to_numpy())
        place = at[mine] - (at[scored][0] if len(n) else 0)
        nan = lambda a: [math.nan if x == math.inf else x for x in (a[i] for i in place)]
        cols = {"cohort_n": pa.array(n[place]), "cohort_mean": pa.array(mean[place], mask=n[place] == 0), "cohort_p50": pa.array(nan(p50), pa.float64()), "cohort_p90": pa.array(nan(p90), pa.float64())}
        out = block.take(pa.array(mine)).select(keep)
        return pa.table({c: out[c] for c in keep} | cols)

    return stats


def _by_blocks(ranked: DataFrame, keep: list[str], back: int, block: int) -> DataFrame:
    """Rows ranked within their cohort (`_n`, `_probe`) with the statistics of its last events. A cohort is cut into blocks
    by rank; a block begins with the scores that the window of its first row reaches back to."""
    own = F.floor((F.col("_n") - 1) / block)
    later = F.when(F.col("_probe") == 0, F.floor((F.col("_n") - 1 + back) / block)).otherwise(own)
    rows = ranked.select("*", own.alias("_own"), F.explode(F.sequence(own, later)).alias("_block"))
    rows = rows.select(*dict.fromkeys([*keep, *COHORT, "score", "_n", "_probe", "_own", "_block"]))
    types = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in keep) + ", cohort_n int, cohort_mean double, cohort_p50 double, cohort_p90 double"
    return rows.groupBy(*COHORT, "_block").applyInArrow(_last_events(back, keep), schema)


def cohort_history(scored: DataFrame, cfg: dict = D.BASELINE, block: int = BLOCK) -> DataFrame:
    """order_id, score_head and the cohort of market, vertical, tenure and head after the order: n, mean, p50, p90
    over its last events.

    There are a few dozen cohorts, whatever the number of orders, so a cohort is cut into blocks by exact ranks of time."""
    ranked = running(cohort_rows(scored, cfg), COHORT, [F.col("event_ts"), F.col("order_id")], name="_n").withColumn("_probe", F.lit(0))
    out = _by_blocks(ranked, ["order_id", "event_ts", *COHORT, "score"], cfg["cohort_events"] - 1, block)
    return out.withColumn("cohort_lift", cohort_lift(cfg))


def cohorts_as_of(orders: DataFrame, log: DataFrame, cfg: dict = D.BASELINE, block: int = BLOCK) -> DataFrame:
    """order_id, score_head, cohort_n, cohort_p50: the order's cohorts after itself if it is a settled one of the log, else
    after the last settled order before it by event_ts and order_id; no row where there is none.

    Orders that ask are ranked among the log's, so they find their block without a lookup."""
    rows = cohort_rows(log, cfg).withColumn("_probe", F.lit(0)).unionByName(cohort_rows(orders, cfg, settled=False).withColumn("_probe", F.lit(1)))
    ranked = running(rows, COHORT, [F.col("event_ts"), F.col("order_id"), F.col("_probe")], 1 - F.col("_probe"), "_n")
    out = _by_blocks(ranked.where("_n > 0"), ["order_id", "score_head", "_probe"], cfg["cohort_events"] - 1, block)
    return out.where("_probe = 1").select("order_id", "score_head", "cohort_n", "cohort_p50")


def cohort_lift(cfg: dict = D.BASELINE) -> Column:
    return F.when(F.col("cohort_n") >= cfg["cohort_support"], F.col("score") / F.greatest("cohort_p50", F.lit(1e-6))).otherwise(F.lit(1.0))


def discount(lift: Column, delta: Column, min_lift: float, min_delta: float, cfg: dict = D.BASELINE) -> Column:
    part = F.greatest(F.greatest(F.lit(0.0), lift - 1) * cfg["per_lift"], F.greatest(F.lit(0.0), delta / 100.0) * cfg["max_discount"])
    return F.when((lift < min_lift) & (delta < min_delta), F.lit(0.0)).otherwise(F.least(F.lit(cfg["max_discount"]), part))


def under_threshold(cfg: dict = D.BASELINE) -> Column:
    return F.when(F.col("score_head") == "fraud", cfg["under_fraud"]).otherwise(cfg["under_abuse"])


def with_discounts(rows: DataFrame, cfg: dict = D.BASELINE) -> DataFrame:
    """precision_discount and its source for rows of an order and key with score, support, is_clean, elevated_streak, lift,
    abs_delta and the cohort's cohort_n, cohort_p50 and cohort_lift: by the key's own baseline or by its cohort,
    whichever is larger."""
    c = cfg
    thin = F.col("entity_kind").isin("ud", "uv", "vd", "uvd") & (F.col("support") < c["pair_min"])
    raw = (F.col("abs_delta") >= c["delta"]) | (F.col("lift") >= c["lift"])
    own = F.when(thin | ~F.col("is_clean") | (F.col("elevated_streak") < c["streak"]) | ~raw, F.lit(0.0)).otherwise(discount(F.col("lift"), F.col("abs_delta"), c["lift"], c["delta"], c))
    gap = F.col("score") - F.col("cohort_p50")
    peer = F.when((F.col("cohort_n") >= c["cohort_support"]) & ((F.col("cohort_lift") >= c["cohort_lift"]) | (gap >= c["cohort_delta"])), discount(F.col("cohort_lift"), gap, c["cohort_lift"], c["cohort_delta"], c)).otherwise(F.lit(0.0))
    rows = rows.withColumns({"_own": own, "_peer": F.coalesce(peer, F.lit(0.0))})
    return rows.withColumns({"precision_discount": F.greatest("_own", "_peer"), "source": F.when(F.col("_peer") > F.col("_own"), "cohort").otherwise("self")}).drop("_own", "_peer")


def signals(history: DataFrame, cohorts: DataFrame, cfg: dict = D.BASELINE) -> DataFrame:
    """Discounts of settled orders by the baselines and cohorts right after them."""
    return with_discounts(history.join(cohorts.select("order_id", "score_head", "cohort_n", "cohort_p50", "cohort_lift"), ["order_id", "score_head"], "left"), cfg)


def baseline_gate(sig: DataFrame, scored: DataFrame, cfg: dict = D.BASELINE) -> DataFrame:
    """Per order: discounts by head, points to relax (capped), the flag for a human, trust credit and evidence codes."""
    c = cfg
    head = lambda h: F.coalesce(F.max(F.when(F.col("score_head") == h, F.col("precision_discount"))), F.lit(0.0))
    clean = lambda k: F.coalesce(F.max(F.when(F.col("entity_kind") == k, F.col("is_clean"))), F.lit(False))
    code = F.when(F.col("precision_discount") > 0, F.concat(F.when(F.col("source") == "cohort", "COHORT_ELEVATED_").otherwise("BASELINE_ELEVATED_"), F.upper("entity_kind")))
    calm = F.when(F.col("is_clean") & (F.col("score") < F.col("under_threshold")), F.concat(F.lit("BASELINE_CLEAN_"), F.upper("entity_kind")))
    out = sig.groupBy("order_id").agg(head("abuse").alias("abuse_discount"), head("fraud").alias("fraud_discount"), clean("user").alias("_u"), clean("device").alias("_d"), F.sort_array(F.collect_set(code)).alias("_e"), F.sort_array(F.collect_set(calm)).alias("_c"))
    out = out.join(scored.select("order_id", "abuse_score", "fraud_score"), "order_id")
    relax = {h: F.col(f"{h}_discount") * 100.0 * c["relax_per_pp"] for h in ("abuse", "fraud")}
    raw = F.greatest(*relax.values())
    trust = (F.col("abuse_discount") <= 0) & (F.col("fraud_discount") <= 0) & F.col("_u") & F.col("_d") & (F.col("abuse_score") <= c["trust_abuse"]) & (F.col("fraud_score") <= c["trust_fraud"])
    out = out.withColumns({f"{h}_relax": F.least(r, F.lit(c["max_relax"])) for h, r in relax.items()} | {"hil_required": raw > c["max_relax"] + 1e-9, "hil_remainder": F.greatest(F.lit(0.0), raw - c["max_relax"]), "trust_credit": trust})
    codes = F.concat("_c", "_e", F.array_compact(F.array(F.when(F.col("hil_required"), F.lit("BASELINE_HIL_RELAX")), F.when(F.col("trust_credit"), F.lit("BASELINE_TRUST_CREDIT")))))
    return out.withColumns({"tighten": F.when(F.col("trust_credit"), c["tighten"]).otherwise(0.0), "target_precision": F.greatest(F.lit(0.5), c["target"] - F.greatest("abuse_discount", "fraud_discount")), "baseline_codes": codes}).drop("_u", "_d", "_e", "_c", "abuse_score", "fraud_score")


LEVELS = ("soft_friction", "hold_review", "auto_deny")


def warped(abuse=D.ABUSE_LADDER, fraud=D.FRAUD_LADDER) -> dict[str, Column]:
    """Ladders lowered by a relaxation and raised by the trust credit, within 0 and 100: the joint one by the larger of both
    heads' relaxations, each head's own ({head}_soft_friction and so on) by that head's alone."""
    relax = {h: F.coalesce(f"{h}_relax", F.lit(0.0)) for h in ("abuse", "fraud")}
    up = F.coalesce("tighten", F.lit(0.0))
    warp = lambda base, down: F.least(F.lit(100.0), F.greatest(F.lit(0.0), base - down) + up)
    cols = {k: warp(F.col(k), F.greatest(*relax.values())) for k in LEVELS}
    return cols | {f"{h}_{k}": warp(F.lit(float(v)), relax[h]) for h, ladder in (("abuse", abuse), ("fraud", fraud)) for k, v in zip(LEVELS, ladder, strict=True)}


def warp_thresholds(df: DataFrame, gate: DataFrame, abuse=D.ABUSE_LADDER, fraud=D.FRAUD_LADDER) -> DataFrame:
    """df with warped ladders, by the gate of each order."""
    out = df.join(gate.select("order_id", "abuse_relax", "fraud_relax", "tighten"), "order_id", "left")
    return out.withColumns(warped(abuse, fraud)).drop("abuse_relax", "fraud_relax", "tighten")


def baseline_features(keys: DataFrame, baselines: DataFrame, kinds: list[str]) -> DataFrame:
    """order_id and four columns of each entity kind from the standing baseline of its key (exploded keys of an order): lift
    of the last score, rate under the threshold, elevated streak, clean flag; 1, 0, 0, 0 where there is none."""
    lift = F.col("score") / F.greatest("baseline_mean", F.lit(1e-6))
    own = baselines.select(*KEY, F.struct(lift.alias("lift"), "under_rate", F.col("elevated_streak").cast("double").alias("elevated_streak"), F.col("is_clean").cast("double").alias("is_clean")).alias("_b"))
    found = keys.select("order_id", "entity_kind", *KEY).join(own, KEY, "left")
    wide = found.groupBy("order_id").pivot("entity_kind", kinds).agg(F.first("_b", True))
    names = {"lift": ("{}_baseline_lift", 1.0), "under_rate": ("{}_baseline_under_rate", 0.0), "elevated_streak": ("{}_baseline_elevated_streak", 0.0), "is_clean": ("{}_is_clean_baseline", 0.0)}
    return wide.select("order_id", *[F.coalesce(F.col(f"{k}.{c}"), F.lit(default)).alias(name.format(k)) for k in kinds for c, (name, default) in names.items()])


def export_baselines(baselines: DataFrame, path: str, as_of_date: str, version: str, clean_only: bool = False) -> None:
    """Standing baselines by as_of_date, market, vertical and kind; only the partitions it holds are replaced."""
    from claimlens.operators.graph import export_snapshot

    export_snapshot(baselines.where("is_clean") if clean_only else baselines, path, as_of_date, version, ["market", "vertical", "entity_kind"])


def latest_cohorts(history: DataFrame) -> DataFrame:
    """Each cohort as its last order left it."""
    values = ["cohort_n", "cohort_mean", "cohort_p50", "cohort_p90"]
    last = history.groupBy(*COHORT).agg(F.max_by(F.struct(*values), F.struct("event_ts", "order_id")).alias("_last"))
    return last.select(*COHORT, *[F.col(f"_last.{v}").alias(v) for v in values])


def export_cohorts(cohorts: DataFrame, path: str, as_of_date: str, version: str) -> None:
    """Standing cohorts by as_of_date, market and vertical; only the partitions it holds are replaced."""
    from claimlens.operators.graph import export_snapshot

    export_snapshot(cohorts, path, as_of_date, version, ["market", "vertical"])
