"""Queries over inputs derived so that they reach what the given data leave idle: slices that may be promoted, every decision
mode and the hard gate, short lookbacks, small samples, exports; with their DuckDB twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from claimlens.functions import defaults as D
from claimlens.operators import baselines as B
from claimlens.operators import evaluation as E
from claimlens.operators import graph, labels, scoring
from claimlens.plans import baseline_queries as BQ
from claimlens.plans import evaluation_queries as EQ
from claimlens.plans import graph_queries as G
from claimlens.plans import label_queries as L
from claimlens.plans import score_queries as S
from claimlens.plans import serving_queries as SQ
from claimlens.plans.feature_queries import VIEWS, features
from claimlens.sources.tables import shared_folder
from claimlens.sources.views import view, with_views

SEPARATED = "CASE WHEN y = 1 THEN 45.0 + order_id % 50 ELSE CAST(order_id % 60 AS DOUBLE) END"


def fresh(spark) -> str:
    return f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"


def promoted(spark, sf):
    """Overlays of slices whose scores tell positives apart well enough to be promoted."""
    rows = EQ.frame(spark, sf).withColumn("decision_score", F.expr(f"CAST({SEPARATED} AS DOUBLE)"))
    return E.overlays(E.recommend_ladders(rows, "decision_score", "y", ["market", "vertical"], "cents"))


APART = (*EQ.EV[:-1], EQ.EV[-1].replace("ev AS (", "ev_raw AS (", 1), f"ev AS (SELECT * REPLACE (CAST({SEPARATED} AS DOUBLE) AS decision_score) FROM ev_raw)")


def modes(spark, sf):
    """The tier of each decision mode, with a strong fraud label of the past on some orders."""
    df = scoring.with_standin_scores(scoring.with_entity_scores(features(spark, sf))).withColumn("prior_strong_fraud", (F.col("order_id") % 37 == 0).cast("double"))
    df = scoring.with_thresholds(df)
    for mode in ("decision_primary", "learning_primary", "score_only"):
        df = scoring.with_decision(df, mode).withColumnRenamed("tier", mode)
    return df.select("order_id", "decision_primary", "learning_primary", "score_only", F.round("combined_score", 6).alias("combined_score"), F.col("hard_gate").cast("int").alias("hard_gate"))


_gated = lambda tier: f"CASE WHEN order_id % 37 = 0 THEN '{D.TIERS[3]}' ELSE {tier} END"
BANDS = f"CASE WHEN combined_score <= 25 THEN '{D.TIERS[0]}' WHEN combined_score <= 50 THEN '{D.TIERS[1]}' WHEN combined_score <= 75 THEN '{D.TIERS[2]}' ELSE '{D.TIERS[3]}' END"


def recent(spark, sf):
    return labels.lookback(view(spark, sf, "hist"), 9).groupBy("market").agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))


def pruned(spark, sf):
    few = labels.random_cap(view(spark, sf, "ord"), 7)
    return labels.prune_history(view(spark, sf, "hist"), few, view(spark, sf, "dev")).select("order_id")


def sampled(spark, sf):
    out = labels.training_frame(L.labelled(spark, sf), view(spark, sf, "hist"), view(spark, sf, "dev"), view(spark, sf, "usr"), max_rows=90)
    return out.select("order_id", F.round("user_refund_rate_30d", 6).alias("user_refund_rate_30d"), "abuse_label")


def cohort_table(spark, sf):
    """Standing cohorts written as of a day and read back."""
    path = fresh(spark)
    B.export_cohorts(B.latest_cohorts(B.cohort_history(SQ.score_log(spark, sf))), path, "2024-02-01", "v1")
    return spark.read.parquet(path).select(F.col("as_of_date").cast("string").alias("as_of_date"), "version", *B.COHORT, "cohort_n", *BQ.R("cohort_mean", "cohort_p50", "cohort_p90"))


def clean_table(spark, sf):
    """Only the clean standing baselines, written as of a day and read back."""
    path = fresh(spark)
    rows = B.latest_baselines(BQ.history_of(SQ.score_log(spark, sf)))
    B.export_baselines(rows.select("entity_kind", "entity_key", "market", "vertical", "n_observations", "baseline_mean", "is_clean"), path, "2024-02-01", "v1", clean_only=True)
    return spark.read.parquet(path).select(F.col("as_of_date").cast("string").alias("as_of_date"), "entity_kind", "entity_key", "market", "vertical", *BQ.R("baseline_mean"))


def graph_tables(spark, sf):
    """Edges and nodes of the graph as snapshots of a day; one day written twice counts once."""
    edges_at, nodes_at = fresh(spark), fresh(spark)
    edges = graph.uv_edges(view(spark, sf, "hist"), null_test=False)
    for day in ("2024-01-31", "2024-02-01", "2024-02-01"):
        graph.export_snapshot(edges, edges_at, day, "v1", ["market"])
        graph.export_snapshot(graph.uv_nodes(edges), nodes_at, day, "v1", ["market", "entity_kind"])
    count = lambda at, what, n: spark.read.parquet(at).groupBy(F.lit(what).alias("what"), F.col("as_of_date").cast("string").alias("as_of_date"), "market").agg(F.count("*").alias("n"), n.cast("long").alias("n_orders"))
    return count(edges_at, "edges", F.sum("n_orders")).unionByName(count(nodes_at, "nodes", F.sum("n_orders")))


def resampled(spark, sf):
    """Bounds of the precision at 35 over 100 resamples."""
    out = E.bootstrap_precision(EQ.frame(spark, sf), "decision_score", "y", 35.0, rounds=100)
    return out.select(F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"))


def queries():
    return {"promotable_overlays": promoted, "decision_modes": modes, "history_recent": recent, "history_pruned_few": pruned, "training_frame_sampled": sampled, "cohort_export": cohort_table, "clean_export": clean_table, "graph_export": graph_tables, "bootstrap_bounds": resampled}


M = E.PRIME


def _bounds(rounds: int) -> str:
    at = E.poisson_steps()
    weight = " + ".join(f"CASE WHEN u >= {x!r} THEN 1 ELSE 0 END" for x in at)
    return f"""SELECT round(quantile_cont(p, 0.025), 6) AS lo, round(quantile_cont(p, 0.975), 6) AS hi FROM (SELECT r, sum(y * w) / nullif(sum(w), 0) AS p FROM (
 SELECT y, r, {weight} AS w FROM (SELECT y, r, ((x2 * x2 + 1) % {M}) / CAST({M} AS DOUBLE) AS u FROM (SELECT y, r, (x1 * x1 + r * 40692 + k) % {M} AS x2 FROM (
 SELECT y, r, k, (k * 48271 + r * 69621 + 12345) % {M} AS x1 FROM (SELECT y, CAST(order_id % {M} AS BIGINT) AS k FROM ev WHERE decision_score >= 35), (SELECT CAST(unnest(range(1, {rounds + 1})) AS BIGINT) AS r))))) GROUP BY r)"""


def oracle_sql():
    modes_sql = f"SELECT order_id, {_gated('tier')} AS decision_primary, {_gated('head_tier')} AS learning_primary, {_gated(BANDS)} AS score_only, round(CASE WHEN order_id % 37 = 0 THEN greatest(combined_score, 90.0) ELSE combined_score END, 6) AS combined_score, CAST(order_id % 37 = 0 AS INT) AS hard_gate FROM tiered"
    last = "(SELECT *, row_number() OVER (PARTITION BY market, vertical, tenure_bucket, score_head ORDER BY event_ts DESC, order_id DESC) AS k FROM ch)"
    days = "(VALUES ('2024-01-31'), ('2024-02-01')) d(as_of_date)"
    return {
        "promotable_overlays": with_views(EQ.ALL, *APART, EQ._sweep_sql("decision_score", "y", ("market", "vertical")), EQ._ladder_sql(("market", "vertical")), EQ.oracle_sql()["slice_overlays"].rsplit("\n", 1)[1]),
        "decision_modes": with_views(VIEWS, *S.PARTS, modes_sql),
        "history_recent": with_views("hist", "SELECT market, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM hist WHERE event_ts >= (SELECT max(event_ts) - INTERVAL '9' DAY FROM hist) GROUP BY 1"),
        "history_pruned_few": L.oracle_sql()["history_pruned"].replace("LIMIT 5000", "LIMIT 7"),
        "training_frame_sampled": with_views(L.ALL, *L.DISP, *L.FEATURE_PARTS, "sm AS (WITH " + L._sample(90) + ")", "SELECT f.order_id, round(f.user_refund_rate_30d, 6) AS user_refund_rate_30d, s.abuse_label FROM feat f JOIN sm s ON s.order_id = f.order_id"),
        "cohort_export": with_views(VIEWS, *SQ.LOG, *SQ.COHORT, f"SELECT '2024-02-01' AS as_of_date, 'v1' AS version, market, vertical, tenure_bucket, score_head, CAST(cohort_n AS INT) AS cohort_n, round(cohort_mean, 6) AS cohort_mean, round(cohort_p50, 6) AS cohort_p50, round(cohort_p90, 6) AS cohort_p90 FROM {last} WHERE k = 1"),
        "clean_export": with_views(VIEWS, *SQ.LOG, *SQ.HISTORY, "SELECT '2024-02-01' AS as_of_date, entity_kind, entity_key, market, vertical, round(baseline_mean, 6) AS baseline_mean FROM (SELECT *, row_number() OVER (PARTITION BY entity_key, market, vertical ORDER BY event_ts DESC, order_id DESC) AS k FROM bh) WHERE k = 1 AND is_clean"),
        "graph_export": with_views("hist", *G._edges_of("hist", ""), f"""SELECT 'edges' AS what, as_of_date, market, count(*) AS n, CAST(sum(n_orders) AS BIGINT) AS n_orders FROM e, {days} GROUP BY ALL
 UNION ALL SELECT 'nodes', as_of_date, market, count(*), CAST(sum(o) AS BIGINT) FROM (SELECT market, vertical, user_id AS i, 'u' AS kind, sum(n_orders) AS o FROM e WHERE elevated GROUP BY ALL UNION ALL SELECT market, vertical, vendor_id, 'v', sum(n_orders) FROM e WHERE elevated GROUP BY ALL), {days} GROUP BY ALL"""),
        "bootstrap_bounds": EQ.q(_bounds(100)),
    }
