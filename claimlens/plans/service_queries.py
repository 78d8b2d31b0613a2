"""Queries of sources, sinks, lookups and whole evaluation jobs with their DuckDB twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from claimlens.functions import defaults as D
from claimlens.functions.signals import envelopes, normalize_sdk
from claimlens.operators import baselines as B
from claimlens.operators import evaluation as E
from claimlens.operators import graph, labels, pit, scoring
from claimlens.plans import baseline_queries as BQ
from claimlens.plans import evaluation_queries as EQ
from claimlens.plans import graph_queries as G
from claimlens.plans import score_queries as S
from claimlens.plans.feature_queries import FEATURE_PARTS, VIEWS, tables
from claimlens.plans.label_queries import DISP, labelled
from claimlens.sources.tables import shared_folder, written
from claimlens.sources.views import query_source, view, with_views

KINDS = list(scoring.KINDS)


def fresh(spark) -> str:
    return f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"


def lookup(spark, sf):
    """What the standing baselines say about each order's keys."""
    df = BQ.scored(spark, sf)
    keys = scoring.entity_keys(df)
    out = B.baseline_features(keys, B.latest_baselines(B.baseline_history(B.settled_observations(keys))), KINDS)
    return out.select("order_id", *[F.round(c, 6).alias(c) for c in out.columns if c != "order_id"])


_PARTS = {"baseline_lift": ("score / greatest(baseline_mean, 1e-6)", "1.0"), "baseline_under_rate": ("under_rate", "0.0"), "baseline_elevated_streak": ("elevated_streak", "0.0"), "is_clean_baseline": ("CAST(is_clean AS INT)", "0.0")}
LAST = "lb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity_key, market, vertical ORDER BY event_ts DESC, order_id DESC) AS k FROM bh) WHERE k = 1)"
LOOKUP = "SELECT q.order_id, " + ", ".join(f"round(CAST(coalesce(max(CASE WHEN q.entity_kind = '{k}' THEN b.{c} END), {d}) AS DOUBLE), 6) AS {k}_{c}" for k in KINDS for c, (_, d) in _PARTS.items()) + f"""
FROM okeys q LEFT JOIN (SELECT entity_key, market, vertical, {", ".join(f"{e} AS {c}" for c, (e, _) in _PARTS.items())} FROM lb) b ON b.entity_key = q.entity_key AND b.market = q.market AND b.vertical = q.vertical GROUP BY 1"""


def exported(spark, sf):
    """Standing baselines written as of a day and read back."""
    path = fresh(spark)
    rows = B.latest_baselines(BQ.history_of(BQ.scored(spark, sf)))
    B.export_baselines(rows.select("entity_kind", "entity_key", "market", "vertical", "n_observations", "baseline_mean"), path, "2024-02-01", "v1")
    back = spark.read.parquet(path)
    return back.select(F.col("as_of_date").cast("string").alias("as_of_date"), "version", "entity_kind", "entity_key", "market", "vertical", "n_observations", F.round("baseline_mean", 6).alias("baseline_mean"))


def shadow(spark, sf):
    """A dual run: all effect rules in shadow mode, held against the labels."""
    decided = scoring.with_effect(S.scored(spark, sf), [r | {"mode": "shadow"} for r in D.EFFECT_RULES])
    out = E.shadow_precision(decided, labelled(spark, sf))
    return out.withColumn("precision", F.round("precision", 6))


def oot(spark, sf):
    _, test, _ = labels.time_split(EQ.frame(spark, sf))
    out = E.oot_evaluation(test)
    return out.withColumns({"value": F.round("value", 6), "ok": F.col("ok").cast("int")})


def backtest(spark, sf):
    train, test, how = labels.time_split(EQ.frame(spark, sf))
    out = E.backtest_report(train, test, how["temporal_ok"])
    return out.withColumn("value", F.round("value", 6))


CUT = "(SELECT max(event_ts) - INTERVAL '7' DAY FROM ev_all)"
SPLIT = (*EQ.EV[:-1], EQ.EV[-1].replace("ev AS (", "ev_all AS (", 1), f"ev AS (SELECT * FROM ev_all WHERE event_ts >= {CUT})")
AP = "SELECT sum(p * tp / tn) / sum(p) AS ap FROM (SELECT p, sum(c) OVER (ORDER BY s DESC) AS tn, sum(p) OVER (ORDER BY s DESC) AS tp FROM (SELECT decision_score AS s, count(*) AS c, count(CASE WHEN fraud_label_source = 'proven' THEN 1 END) AS p FROM ev GROUP BY 1))"
OOT = f"""mt AS (SELECT 'holdout_n' AS metric, CAST((SELECT count(*) FROM ev) AS DOUBLE) AS value UNION ALL SELECT 'proven_positives', (SELECT count(CASE WHEN fraud_label_source = 'proven' THEN 1 END) FROM ev) UNION ALL SELECT 'fraud_proven_average_precision', ap FROM ({AP})
 UNION ALL SELECT 'fraud_proven_precision_at_soft', count(CASE WHEN fraud_label_source = 'proven' THEN 1 END) / nullif(count(*), 0) FROM ev WHERE decision_score >= {D.LADDER[0]}
 UNION ALL SELECT 'decision_ece', sum(c * abs(a - m)) / sum(c) FROM (SELECT count(*) AS c, avg(decision_score / 100.0) AS m, avg(CAST(y AS DOUBLE)) AS a FROM ev GROUP BY least(floor(decision_score / 10), 9))),
fl AS (SELECT * FROM (VALUES {", ".join(f"('{k[4:]}', CAST({v} AS DOUBLE), {str(k.startswith('min_')).upper()})" for k, v in D.OOT_FLOORS.items())}) t(metric, floor, low))"""
OOT_SELECT = "SELECT f.metric, round(m.value, 6) AS value, f.floor, CAST(coalesce(CASE WHEN f.low THEN m.value >= f.floor ELSE m.value <= f.floor END, FALSE) AS INT) AS ok FROM fl f JOIN mt m ON m.metric = f.metric"
_ON_TRAIN = lambda text: text.replace("FROM ev GROUP", "FROM ev_train GROUP")
BACKTEST = (
    f"ev_train AS (SELECT * FROM ev_all WHERE event_ts < {CUT})", EQ.METRICS, EQ.PSI.replace("FROM ev)", "FROM ev_all)"), _ON_TRAIN(EQ._sweep_sql("decision_score", "y")), EQ._ladder_sql(),
    "mw AS (" + EQ.METRICS_SELECT + ")", "pw AS (" + EQ.PSI_SELECT + ")",
    f"""wide AS (SELECT (SELECT count(*) FROM ev) AS n_test, (SELECT count(*) FROM ev_train) AS n_train, brier AS decision_brier, ece_fixed AS decision_ece, auc, average_precision, precision, recall, fp_rate, pattern_recall, psi AS psi_train_test, soft_friction, hold_review, auto_deny, ladder_ok, 1 AS temporal_ok,
 CAST(brier > {D.CEILINGS['decision_brier']} AS INT) + CAST(ece_fixed > {D.CEILINGS['decision_ece']} AS INT) + CAST(psi > {D.CEILINGS['psi_train_test']} AS INT) AS gate_breaches FROM mw, pw, (SELECT soft_friction, hold_review, auto_deny, CAST(soft_cut IS NOT NULL AND soft_friction >= 10 AND n_pred >= 10 AND ce - ma + 1e-12 >= 0.15 AND NOT (n < 20 OR n_pos < 3) AS INT) AS ladder_ok FROM lad))""",
    "full_row AS (SELECT CAST(COLUMNS(*) AS DOUBLE) FROM (SELECT *, CASE WHEN ladder_ok = 1 AND gate_breaches = 0 THEN 1 ELSE 0 END AS promote_ok FROM wide))",
)
BACKTEST_SELECT = "SELECT metric, round(value, 6) AS value FROM (UNPIVOT full_row ON COLUMNS(*) INTO NAME metric VALUE value)"


def enveloped(spark, sf):
    """The SDK events as senders write them: one object a line, other names, lists and {"events": [...]}; read back."""
    e = view(spark, sf, "sdk").withColumns({"_t": F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "_p": F.from_json("payload", "map<string,double>"), "_k": F.col("order_id") % 4, "_c": F.col("confidence").cast("string"), "order_id": F.col("order_id").cast("string")})
    plain = F.to_json(F.struct("order_id", "source", F.col("_c").alias("confidence"), F.col("_t").alias("event_ts"), F.col("_p").alias("payload")))
    other = F.to_json(F.struct("order_id", F.col("source").alias("kind"), F.col("_c").alias("conf"), F.col("_t").alias("captured_at"), F.col("payload").alias("signals")))
    third = F.to_json(F.struct("order_id", F.col("source").alias("signal_type"), F.col("_c").alias("confidence"), F.col("_t").alias("ts"), F.col("_p").alias("data")))
    inferred = F.to_json(F.struct("order_id", F.col("_c").alias("conf"), F.col("_t").alias("ts"), F.when(F.col("source") != "claim_vision", F.col("_p")).alias("device_intelligence"), F.when(F.col("source") == "claim_vision", F.col("_p")).alias("claim_vision")))
    lines = e.select(F.when(F.col("_k") == 0, plain).when(F.col("_k") == 1, F.concat(F.lit("["), other, F.lit("]"))).when(F.col("_k") == 2, F.concat(F.lit('{"events":['), third, F.lit("]}"))).otherwise(inferred).alias("value"))
    out = normalize_sdk(envelopes(lines).withColumn("order_id", F.col("order_id").cast("long")))
    return out.select("order_id", "source", F.col("accepted").cast("int").alias("accepted"), "event_ts", *[F.round(c, 6).alias(c) for c in ["confidence", *G.PLATFORM]])


def resolved(spark, sf):
    out, source = labels.load_training_orders(view(spark, sf, "ord"), view(spark, sf, "disp"), view(spark, sf, "sdk"))
    rates = labels.training_rates(out).withColumn("orders_source", F.lit(source))
    return rates.select("orders_source", "n", "n_proven", *[F.round(c, 6).alias(c) for c in ("proven_rate", "weak_policy_negative_rate")])


FEED = "SELECT order_id, max_by(disposition, disposition_ts) AS disposition, max(disposition_ts) AS disposition_ts FROM {feed} GROUP BY order_id"


def fed(spark, sf):
    """A dispositions feed that is given as SQL text."""
    return query_source(spark, FEED, feed=view(spark, sf, "disp"))


def looked_up(spark, sf):
    """The decision log, appended in two parts to a table by day, and what it holds of one order."""
    path, snaps = fresh(spark), written(scoring.snapshots(S.scored(spark, sf)))
    for part in (0, 1):
        scoring.archive_append(snaps.where(F.col("order_id") % 2 == part), path)
    log = spark.read.parquet(path)
    first = log.agg(F.min("order_id")).first()[0]
    rows = scoring.archive_lookup(log, first).unionByName(log.where(F.col("order_id") > first))
    return rows.select("order_id", "ts", "tier", "final_effect", "reason_codes_json")


def stored(spark, sf):
    """Snapshots written as a table and read by key: one order id in a hundred."""
    path = fresh(spark)
    scoring.snapshots(S.scored(spark, sf)).withColumn("day", F.to_date("event_ts")).write.partitionBy("day").parquet(path)
    rows = spark.read.parquet(path).where("order_id % 100 = 0")
    return rows.select("order_id", "tier", F.round("entity_scores.user", 6).alias("user_score"), F.round("link_scores.uvd", 6).alias("uvd_score"), F.size("reason_codes").alias("n_reasons"))


def proposed(spark, sf):
    """Shadow proposals of segments whose last day lies above their baseline at all (z of 0), written and read back."""
    path = fresh(spark)
    found = E.segment_anomalies(E.daily_refund_series(view(spark, sf, "hist")), z=0.0)
    E.proposals(found).write.mode("append").parquet(path)
    return spark.read.parquet(path).select("kind", "mode", F.col("auto_enforce").cast("int").alias("auto_enforce"), "market", "vertical")


def ops_feed(spark, sf):
    """Ops snapshots as JSON, one a day, flat and nested; the newest counts."""
    days = view(spark, sf, "hist").groupBy(F.to_date("event_ts").alias("day")).agg(F.count("*").alias("n"), F.sum("is_refund").alias("r"))
    row = lambda rate: F.struct(rate.alias("refund_grant_rate"), (F.col("n") / 2).alias("cs_queue_depth"), F.lit("x").alias("hold_rate"))
    raw = days.select(F.col("day").cast("string").alias("as_of"), F.to_json(F.struct(row(F.col("r") / F.col("n")).alias("metrics"))).alias("_j"))
    kind = "struct<metrics:struct<refund_grant_rate:string,cs_queue_depth:string,hold_rate:string>>"
    out = E.ops_snapshot(raw.select("as_of", F.from_json("_j", kind).alias("_x")).select("as_of", "_x.metrics"))
    return out.select(F.col("as_of").cast("date").cast("string").alias("as_of"), F.round("refund_grant_rate", 6).alias("refund_grant_rate"), "cs_queue_depth", "hold_rate")


def replay(spark, sf):
    """Orders of the first half of the time span: all features over all history and over that half alone. For each
    feature how many orders it was compared on, and on how many it differs (none, if nothing leaks)."""
    orders, hist, dev, usr = tables(spark, sf)
    span = hist.agg(F.min(F.unix_micros("event_ts")), F.max(F.unix_micros("event_ts"))).first()
    early = F.unix_micros("event_ts") < (span[0] + span[1]) // 2
    o = orders.where(early)
    full, cut = pit.order_features(o, hist, dev, usr), pit.order_features(o, hist.where(early), dev, usr)
    names = [c for c, t in full.dtypes if t in ("double", "bigint", "int") and c not in o.columns]
    # written, so that one stage holds the sorts of one side's features
    full, cut = written(full.select("order_id", *names)), written(cut.select("order_id", *names))
    both = full.join(cut.select("order_id", *[F.col(c).alias(f"_{c}") for c in names]), "order_id")
    sums = both.agg(F.count("*").alias("n"), *[F.count_if(~F.col(c).eqNullSafe(F.col(f"_{c}"))).alias(c) for c in names])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col("n").alias("n_orders"), F.col(c).alias("n_different")) for c in names])).alias("_x")).select("_x.*")


def queries():
    return {
        "baseline_lookup": lookup, "baseline_export": exported, "shadow_precision": shadow, "oot_evaluation": oot, "backtest_report": backtest, "sdk_envelopes": enveloped, "training_orders": resolved,
        "feed_query": fed, "archive_lookup": looked_up, "snapshot_read": stored, "segment_proposals": proposed, "ops_snapshot": ops_feed, "pit_replay": replay,
    }


def oracle_sql():
    do = lambda *rest: with_views(VIEWS, *S.PARTS, *rest)
    base = lambda *rest: with_views(VIEWS, *BQ.PARTS, *rest)
    listed = f"CASE WHEN length(rc) = 0 THEN '[]' ELSE '[\"' || replace(rtrim(rc, ','), ',', '\",\"') || '\"]' END"
    half = "(SELECT epoch_us(min(event_ts)) + epoch_us(max(event_ts)) FROM hist) // 2"
    return {
        "baseline_lookup": base(*BQ.HISTORY, LAST, LOOKUP),
        "baseline_export": base(*BQ.HISTORY, LAST, "SELECT '2024-02-01' AS as_of_date, 'v1' AS version, entity_kind, entity_key, market, vertical, CAST(n_observations AS INT) AS n_observations, round(baseline_mean, 6) AS baseline_mean FROM lb"),
        "shadow_precision": with_views(EQ.ALL, *S.PARTS, *DISP, "SELECT d.ev AS shadow_effect, count(*) AS n, CAST(sum(h) AS BIGINT) AS n_true, round(avg(h), 6) AS precision FROM decided d JOIN (SELECT order_id, CASE WHEN abuse_label >= 1 OR fraud_label >= 1 THEN 1 ELSE 0 END AS h FROM lab) l ON l.order_id = d.order_id WHERE d.ev IS NOT NULL GROUP BY 1"),
        "oot_evaluation": with_views(EQ.ALL, *SPLIT, OOT, OOT_SELECT),
        "backtest_report": with_views(EQ.ALL, *SPLIT, *BACKTEST, BACKTEST_SELECT),
        "sdk_envelopes": G.oracle_sql()["sdk_normalized"],
        "training_orders": with_views("ord disp", *DISP, "SELECT 'orders' AS orders_source, count(*) AS n, count(CASE WHEN fraud_label_source = 'proven' THEN 1 END) AS n_proven, round(avg(CASE WHEN fraud_label_source = 'proven' THEN 1.0 ELSE 0.0 END), 6) AS proven_rate, round(avg(CASE WHEN weak_policy_negative >= 1 THEN 1.0 ELSE 0.0 END), 6) AS weak_policy_negative_rate FROM lab"),
        "feed_query": with_views("disp", FEED.replace("{feed}", "disp").replace("max_by", "arg_max")),
        "archive_lookup": do(f"SELECT order_id, event_ts AS ts, tier, final_effect, {listed} AS reason_codes_json FROM (SELECT *, {S.REASONS} AS rc FROM decided)"),
        "snapshot_read": do(f"SELECT order_id, tier, round(user_score, 6) AS user_score, round(uvd_link_score, 6) AS uvd_score, CAST(len(string_split({S.REASONS}, ',')) - 1 AS INT) AS n_reasons FROM decided WHERE order_id % 100 = 0"),
        "segment_proposals": with_views("hist", EQ.SERIES, "SELECT 'decision_threshold_overlay' AS kind, 'shadow' AS mode, 0 AS auto_enforce, string_split(segment, '|')[1] AS market, string_split(segment, '|')[2] AS vertical FROM (" + EQ.ANOM + ") WHERE z >= 0"),
        "ops_snapshot": with_views("hist", "SELECT CAST(day AS VARCHAR) AS as_of, round(r / n, 6) AS refund_grant_rate, n / 2 AS cs_queue_depth, CAST(NULL AS DOUBLE) AS hold_rate FROM (SELECT CAST(event_ts AS DATE) AS day, count(*) AS n, CAST(sum(is_refund) AS DOUBLE) AS r FROM hist GROUP BY 1) ORDER BY day DESC LIMIT 1"),
        "source_metrics": with_views(EQ.ALL, *EQ.EV, "src AS (SELECT DISTINCT fraud_label_source AS source FROM ev WHERE fraud_label >= 1)", """st AS (SELECT source, score, c, p, coalesce(sum(c) OVER (PARTITION BY source ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bf, sum(c) OVER (PARTITION BY source ORDER BY score DESC) AS tn, sum(p) OVER (PARTITION BY source ORDER BY score DESC) AS tp FROM (
 SELECT s.source, decision_score AS score, count(*) AS c, sum(fraud_label) AS p FROM ev JOIN src s ON fraud_label < 1 OR fraud_label_source = s.source GROUP BY 1, 2))""", "SELECT source, round(CAST((sum(p * (bf + (c + 1) / 2.0)) - sum(p) * (sum(p) + 1) / 2.0) / nullif(sum(p) * (sum(c) - sum(p)), 0) AS DOUBLE), 6) AS auc, round(CAST(sum(p * tp / tn) / nullif(sum(p), 0) AS DOUBLE), 6) AS average_precision FROM st GROUP BY 1"),
    }
