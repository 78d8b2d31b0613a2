"""Queries of thresholds, calibration, drift, gates and segments with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens.functions import defaults as D
from claimlens.operators import evaluation as E
from claimlens.operators import labels, scoring
from claimlens.plans.feature_queries import FEATURE_PARTS, VIEWS, features
from claimlens.plans.label_queries import DISP
from claimlens.plans.score_queries import SCORED
from claimlens.sources.tables import written
from claimlens.sources.views import view, with_views

ALL = "ord dev usr disp"
EV = (*FEATURE_PARTS, SCORED, *DISP, """ev AS (SELECT s.order_id, s.market, s.vertical, s.cents, s.event_ts, round(s.abuse_score, 4) AS abuse_score, round(s.fraud_score, 4) AS fraud_score, round(s.decision_score, 4) AS decision_score, l.abuse_label, l.fraud_label, l.fraud_label_source,
 CASE WHEN l.abuse_label >= 1 OR l.fraud_label >= 1 THEN 1 ELSE 0 END AS y FROM scored s JOIN lab l ON l.order_id = s.order_id)""")


def frame(spark, sf):
    """Stand-in scores (4 digits), labels and y of each order."""
    s = scoring.with_standin_scores(scoring.with_entity_scores(features(spark, sf)))
    lab = labels.apply_dispositions(view(spark, sf, "ord"), view(spark, sf, "disp")).select("order_id", "abuse_label", "fraud_label", "fraud_label_source")
    out = s.join(lab, "order_id").withColumn("y", ((F.col("abuse_label") >= 1) | (F.col("fraud_label") >= 1)).cast("int"))
    return written(out.select("order_id", "market", "vertical", "cents", "event_ts", *[F.round(c, 4).alias(c) for c in ("abuse_score", "fraud_score", "decision_score")], "abuse_label", "fraud_label", "fraud_label_source", "y"))


R = lambda df, *names: df.withColumns({n: F.round(n, 6) for n in names})
q = lambda *rest: with_views(ALL, *EV, *rest)


def _sweep_sql(score, label, by=()):
    k, part = "".join(f"{b}, " for b in by), ("PARTITION BY " + ", ".join(by)) if by else ""
    return f"""steps AS (SELECT {k}{score} AS score, count(*) AS c, sum({label}) AS p, sum(CASE WHEN {label} < 1 THEN cents ELSE 0 END) AS m FROM ev GROUP BY ALL),
sweep AS (SELECT *, n_pred - tp AS fp, tp / nullif(n_pos, 0) AS recall, tp / n_pred AS precision, coalesce((n_pred - tp) / nullif(n - n_pos, 0), 0) AS fp_rate, coalesce(fp_amount / nullif(n_pred - tp, 0), 0) AS fp_amount_mean FROM (
 SELECT {k}score, sum(c) OVER w AS n_pred, sum(p) OVER w AS tp, sum(m) OVER w AS fp_amount, sum(c) OVER ({part}) AS n, sum(p) OVER ({part}) AS n_pos FROM steps WINDOW w AS ({part} ORDER BY score DESC)))"""


def _ladder_sql(by=(), d=D.LADDER):
    k = "".join(f"{b}, " for b in by)
    on = " AND ".join(f"s.{b} = c.{b}" for b in by) or "TRUE"
    return f"""cuts AS (SELECT {k}n, n_pos, soft_cut, soft_friction, hold_review, greatest(coalesce(dd, {d[2]}), hold_review) AS auto_deny FROM (SELECT *, greatest(coalesce(h, {d[1]}), soft_friction) AS hold_review FROM (SELECT *, coalesce(soft_cut, h, {d[0]}) AS soft_friction FROM (
 SELECT {k}max(n) AS n, max(n_pos) AS n_pos, max(CASE WHEN recall + 1e-12 >= 0.98 AND precision + 1e-12 >= 0.15 THEN score END) AS soft_cut, max(CASE WHEN recall >= 0.9 THEN score END) AS h, max(CASE WHEN recall >= 0.5 THEN score END) AS dd FROM sweep {'GROUP BY ' + ', '.join(by) if by else ''})))),
lad AS (SELECT *, (tp / n_pred + 3.8416 / (2.0 * n_pred)) / (1.0 + 3.8416 / n_pred) AS ce, 1.96 * sqrt(tp / n_pred * (1.0 - tp / n_pred) / n_pred + 3.8416 / (4.0 * n_pred * n_pred)) / (1.0 + 3.8416 / n_pred) AS ma FROM (
 SELECT c.*, s.n_pred, s.tp, s.recall, s.precision, s.fp_rate, row_number() OVER ({'PARTITION BY ' + ', '.join('c.' + b for b in by) if by else ''} ORDER BY s.score) AS r FROM cuts c JOIN sweep s ON {on} AND s.score >= c.soft_friction) WHERE r = 1)"""


LADDER_COLS = ["soft_cut", "soft_friction", "hold_review", "auto_deny", "recall", "precision", "fp_rate", "wilson_lo", "wilson_hi"]
_lad_select = lambda by="": f"""SELECT {by}CAST(n AS BIGINT) AS n, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_pred AS BIGINT) AS n_pred, {", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in LADDER_COLS[:7])}, round(greatest(0.0, ce - ma), 6) AS wilson_lo, round(least(1.0, ce + ma), 6) AS wilson_hi,
 CAST(n < 20 OR n_pos < 3 AS INT) AS thin, CAST(soft_cut IS NOT NULL AND soft_friction >= 10 AND n_pred >= 10 AND ce - ma + 1e-12 >= 0.15 AND NOT (n < 20 OR n_pos < 3) AS INT) AS promote FROM lad"""  # noqa: E731


def ladders(by=(), score="decision_score", label="y"):
    def build(spark, sf):
        out = R(E.recommend_ladders(frame(spark, sf), score, label, list(by), "cents"), *LADDER_COLS)
        return out.select(*by, "n", "n_pos", "n_pred", *LADDER_COLS, F.col("thin").cast("int").alias("thin"), F.col("promote").cast("int").alias("promote"))

    return build


def metrics(spark, sf):
    df = frame(spark, sf)
    out = E.brier(df, "decision_score", "y").crossJoin(E.ece(df, "decision_score", "y").select(F.col("ece").alias("ece_fixed"), "n_pos")).crossJoin(E.ece(df, "decision_score", "y", binning="adaptive").select(F.col("ece").alias("ece_adaptive"), "bins"))
    out = out.crossJoin(E.ranking(df, "decision_score", "y")).crossJoin(E.rates_at(df, "decision_score", "y", 35.0)).crossJoin(E.or_head_recall(df, 35.0, 30.0))
    return R(out, "brier", "ece_fixed", "ece_adaptive", "auc", "average_precision", "precision", "recall", "fp_rate", "pattern_recall")


_edges = lambda src, c: f"(SELECT list_sort(list_distinct(quantile_cont({c}, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) FROM {src})"
METRICS = f"""pr AS (SELECT decision_score / 100.0 AS s, CAST(y AS DOUBLE) AS y FROM ev),
fx AS (SELECT sum(c * abs(a - m)) / sum(c) AS ece_fixed FROM (SELECT count(*) AS c, avg(s) AS m, avg(y) AS a FROM pr GROUP BY least(floor(s * 10), 9))),
ad AS (SELECT sum(c * abs(a - m)) / sum(c) AS ece_adaptive, count(*) AS bins FROM (SELECT count(*) AS c, avg(s) AS m, avg(y) AS a FROM (SELECT s, y, least(len(list_filter(e, lambda x: x <= s)) - 1, len(e) - 2) AS b FROM pr, (SELECT {_edges('pr', 's')} AS e)) GROUP BY b)),
st AS (SELECT score, c, p, coalesce(sum(c) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bf, sum(c) OVER (ORDER BY score DESC) AS tn, sum(p) OVER (ORDER BY score DESC) AS tp FROM (SELECT decision_score AS score, count(*) AS c, sum(y) AS p FROM ev GROUP BY 1)),
rk AS (SELECT (sum(p * (bf + (c + 1) / 2.0)) - sum(p) * (sum(p) + 1) / 2.0) / (sum(p) * (sum(c) - sum(p))) AS auc, sum(p * tp / tn) / sum(p) AS average_precision FROM st)"""
METRICS_SELECT = """SELECT round((SELECT avg((s - y) * (s - y)) FROM pr), 6) AS brier, round(ece_fixed, 6) AS ece_fixed, (SELECT CAST(sum(y) AS BIGINT) FROM ev) AS n_pos, round(ece_adaptive, 6) AS ece_adaptive, bins, round(CAST(auc AS DOUBLE), 6) AS auc, round(CAST(average_precision AS DOUBLE), 6) AS average_precision,
 (SELECT round(count(CASE WHEN decision_score >= 35 AND y = 1 THEN 1 END) / count(CASE WHEN decision_score >= 35 THEN 1 END), 6) FROM ev) AS precision, (SELECT round(count(CASE WHEN decision_score >= 35 AND y = 1 THEN 1 END) / sum(y), 6) FROM ev) AS recall,
 (SELECT round(count(CASE WHEN decision_score >= 35 AND y = 0 THEN 1 END) / count(CASE WHEN y = 0 THEN 1 END), 6) FROM ev) AS fp_rate, (SELECT round(count(CASE WHEN y = 1 AND (abuse_score >= 35 OR fraud_score >= 30) THEN 1 END) / sum(y), 6) FROM ev) AS pattern_recall FROM fx, ad, rk"""


def psi(spark, sf):
    train, test, _ = labels.time_split(frame(spark, sf))
    return R(E.psi(train, test, "decision_score"), "psi")


PSI = f"""a AS (SELECT decision_score AS s, event_ts >= (SELECT max(event_ts) - INTERVAL '7' DAY FROM ev) AS test FROM ev),
ed AS (SELECT {_edges('(SELECT * FROM a WHERE NOT test)', 's')} AS e),
bn AS (SELECT b, count(CASE WHEN NOT test THEN 1 END) + 1e-6 AS e, count(CASE WHEN test THEN 1 END) + 1e-6 AS a FROM (SELECT test, greatest(least(len(list_filter(e, lambda x: x <= s)) - 1, len(e) - 2), 0) AS b FROM a, ed WHERE s >= e[1] AND s <= e[-1]) GROUP BY b)"""
PSI_SELECT = "SELECT round(sum((a / ta - e / te) * ln((a / ta) / (e / te))), 6) AS psi FROM bn, (SELECT sum(e) AS te, sum(a) AS ta FROM bn)"


def slices(spark, sf):
    return R(E.slice_metrics(frame(spark, sf), "decision_score", "y"), "recall", "precision").withColumn("thin", F.col("thin").cast("int"))


SLICES = """SELECT coalesce(market, 'ALL') AS market, coalesce(vertical, 'all') AS vertical, count(*) AS n, count(CASE WHEN y = 1 THEN 1 END) AS n_pos, round(count(CASE WHEN y = 1 AND decision_score >= 35 THEN 1 END) / nullif(count(CASE WHEN y = 1 THEN 1 END), 0), 6) AS recall,
 round(count(CASE WHEN y = 1 AND decision_score >= 35 THEN 1 END) / nullif(count(CASE WHEN decision_score >= 35 THEN 1 END), 0), 6) AS precision, CAST(count(*) < 20 OR count(CASE WHEN y = 1 THEN 1 END) < 3 AS INT) AS thin FROM ev GROUP BY ROLLUP (market, vertical)"""


def gate(spark, sf):
    df = frame(spark, sf)
    row = E.brier(df, "decision_score", "y").select(F.col("brier").alias("decision_brier")).crossJoin(E.ece(df, "decision_score", "y").select(F.col("ece").alias("decision_ece")))
    return R(E.monitoring_gate(row), "value")


GATE = """pr AS (SELECT decision_score / 100.0 AS s, CAST(y AS DOUBLE) AS y FROM ev),
mt AS (SELECT 'decision_brier' AS metric, avg((s - y) * (s - y)) AS value FROM pr UNION ALL SELECT 'decision_ece', sum(c * abs(a - m)) / sum(c) FROM (SELECT count(*) AS c, avg(s) AS m, avg(y) AS a FROM pr GROUP BY least(floor(s * 10), 9))),
cl AS (SELECT * FROM (VALUES """ + ", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in D.CEILINGS.items()) + ") t(metric, ceiling))"
GATE_SELECT = "SELECT c.metric, round(m.value, 6) AS value, c.ceiling, CASE WHEN m.value IS NULL THEN 'missing' ELSE 'above' END AS reason FROM cl c LEFT JOIN mt m ON m.metric = c.metric WHERE m.value IS NULL OR m.value > c.ceiling"


def series(spark, sf):
    out = R(E.daily_refund_series(view(spark, sf, "hist")), "refund_rate")
    return out.withColumn("day", F.col("day").cast("string"))


def anomalies(spark, sf):
    out = R(E.segment_anomalies(E.daily_refund_series(view(spark, sf, "hist"))), "baseline_mean", "baseline_std", "test_rate", "z")
    return out.withColumns({"test_day": F.col("test_day").cast("string"), "flagged": F.col("flagged").cast("int")})


SERIES = "ds AS (SELECT market || '|' || vertical AS segment, CAST(event_ts AS DATE) AS day, count(*) AS n, avg(CAST(is_refund AS DOUBLE)) AS refund_rate FROM hist GROUP BY 1, 2 HAVING count(*) >= 5)"
ANOM = """SELECT segment, n_days, round(m, 6) AS baseline_mean, round(sd, 6) AS baseline_std, round(t, 6) AS test_rate, CAST(td AS VARCHAR) AS test_day, round((t - m) / greatest(sd, 1e-9), 6) AS z, CAST((t - m) / greatest(sd, 1e-9) >= 3 AS INT) AS flagged FROM (
 SELECT segment, count(*) AS n_days, avg(CASE WHEN k <= 14 THEN refund_rate END) AS m, stddev_pop(CASE WHEN k <= 14 THEN refund_rate END) AS sd, arg_max(refund_rate, day) AS t, max(day) AS td FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY day) AS k FROM ds) GROUP BY 1) WHERE n_days >= 18"""


def queries():
    return {
        "threshold_sweep": lambda s, d: (lambda x: x.select("score", "n_pred", "tp", "fp", "recall", "precision", "fp_rate", "fp_amount_mean"))(R(E.threshold_sweep(frame(s, d), "decision_score", "y", amount="cents"), "recall", "precision", "fp_rate", "fp_amount_mean")),
        "decision_ladder": ladders(), "abuse_ladder": ladders((), "abuse_score", "abuse_label"), "slice_ladders": ladders(("market", "vertical")),
        "slice_overlays": lambda s, d: E.overlays(E.recommend_ladders(frame(s, d), "decision_score", "y", ["market", "vertical"], "cents")),
        "quality_metrics": metrics, "psi_train_test": psi, "slice_metrics": slices, "monitoring_gate": gate,
        "source_metrics": lambda s, d: R(E.source_metrics(frame(s, d), "decision_score"), "auc", "average_precision"),
        "pack_contract": lambda s, d: E.validate_pack(view(s, d, "ord"), view(s, d, "disp")).withColumn("ok", F.col("ok").cast("int")),
        "bootstrap_precision": lambda s, d: E.bootstrap_precision(frame(s, d), "decision_score", "y", 35.0),
        "daily_refund_series": series, "segment_anomalies": anomalies,
    }


def oracle_sql():
    return {
        "threshold_sweep": q(_sweep_sql("decision_score", "y"), "SELECT score, CAST(n_pred AS BIGINT) AS n_pred, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(recall, 6) AS recall, round(precision, 6) AS precision, round(fp_rate, 6) AS fp_rate, round(fp_amount_mean, 6) AS fp_amount_mean FROM sweep"),
        "decision_ladder": q(_sweep_sql("decision_score", "y"), _ladder_sql(), _lad_select()),
        "abuse_ladder": q(_sweep_sql("abuse_score", "abuse_label"), _ladder_sql(), _lad_select()),
        "slice_ladders": q(_sweep_sql("decision_score", "y", ("market", "vertical")), _ladder_sql(("market", "vertical")), _lad_select("market, vertical, ")),
        "slice_overlays": q(_sweep_sql("decision_score", "y", ("market", "vertical")), _ladder_sql(("market", "vertical")), "SELECT market, vertical, round(soft_friction, 2) AS soft_friction, round(hold_review, 2) AS hold_review, round(auto_deny, 2) AS auto_deny FROM lad WHERE soft_cut IS NOT NULL AND soft_friction >= 10 AND n_pred >= 10 AND ce - ma + 1e-12 >= 0.15 AND NOT (n < 20 OR n_pos < 3)"),
        "quality_metrics": q(METRICS, METRICS_SELECT), "psi_train_test": q(PSI, PSI_SELECT), "slice_metrics": q(SLICES), "monitoring_gate": q(GATE, GATE_SELECT),
        "pack_contract": with_views("ord disp", "SELECT (SELECT count(*) FROM ord) AS n_orders, p AS n_proven, 1 AS ok FROM (SELECT count(DISTINCT order_id) AS p FROM disp WHERE disposition IN (" + ", ".join(repr(k) for k, v in D.OUTCOMES.items() if v[3] == "proven") + "))"),
        "daily_refund_series": with_views("hist", SERIES, "SELECT segment, CAST(day AS VARCHAR) AS day, n, round(refund_rate, 6) AS refund_rate FROM ds"),
        "segment_anomalies": with_views("hist", SERIES, ANOM),
    }
