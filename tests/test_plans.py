"""Plans that keep each task small: what is shared is computed once, and few sorted inputs meet in one stage."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from claimlens.operators import baselines, graph, pit, scoring, serving
from claimlens.plans import label_queries, registry
from claimlens.sources.views import view as registry_view

HISTORY = "order_id string, user_id string, driver_id string, vendor_id string, device_id string, cents long, is_refund int, claim_reason string, status string, vertical string, event_ts timestamp"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def joins(df):
    return sum("Join " in line for line in plan(df).splitlines())


def test_decision_modes_compute_features_once(spark, sf):
    q = registry.queries()
    assert joins(q["decision_modes"](spark, sf)) <= joins(q["order_features"](spark, sf))


def test_replay_joins_two_written_sides(spark, sf):
    assert joins(registry.queries()["pit_replay"](spark, sf)) == 1


def test_sums_of_drivers_vendors_and_links_leave_peers_and_reasons_out(spark, sf):
    for name in ("pit_driver_vendor_features", "pit_link_features"):
        assert joins(registry.queries()[name](spark, sf)) <= 3, name


def test_rows_of_the_order_itself_are_left_out_of_all_sums(spark):
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    row = lambda o, u, n, refund=1: (o, u, "d", "v", f"x{u}", 100, refund, "quality", "delivered", "food", day(n))
    # the order comes twice under its user and once under a peer, all of it its own
    rows = [row("a", "u", 1), row("b", "p", 2), row("o", "u", 3), row("o", "u", 4), row("o", "p", 4)]
    history = spark.createDataFrame(rows, HISTORY)
    orders = spark.createDataFrame([row("o", "u", 4)], HISTORY)
    devices = spark.createDataFrame([("u", "xu", 1), ("p", "xp", 1)], "user_id string, device_id string, cluster_id long")
    got = pit.order_features(orders, history, devices).first()
    assert (got.base_n, got.user_orders_30d, got.vendor_orders_30d, got.driver_refund_count_30d, got.uvd_cooccur) == (2, 1.0, 2.0, 2.0, 1.0)
    assert (got.related_account_count, got.related_max_orders_30d, got.related_refund_cents_30d, got.reason_repeat_rate_30d) == (1.0, 1.0, 100, 0.0)


def test_archive_appends_parts_of_written_snapshots(spark, sf, monkeypatch):
    seen, append = [], scoring.archive_append
    monkeypatch.setattr(scoring, "archive_append", lambda snaps, path: (seen.append(joins(snaps)), append(snaps, path)))
    registry.queries()["archive_lookup"](spark, sf)
    assert seen == [0, 0]


@pytest.mark.parametrize("name", ["proxy_labels", "label_sources", "sample_weights", "mint_self_train"])
def test_labels_that_read_no_graph_column_build_no_graph(spark, sf, monkeypatch, name):
    monkeypatch.setattr(graph, "uv_edges", None)
    monkeypatch.setattr(label_queries, "written", lambda df: df.limit(0))
    registry.queries()[name](spark, sf)


def test_features_that_nobody_asks_for_are_not_computed(spark, sf, monkeypatch):
    seen = []
    monkeypatch.setattr(label_queries, "written", lambda df: seen.append(plan(df)) or df.limit(0))
    registry.queries()["proxy_labels"](spark, sf)
    assert "reason_repeat" not in seen[-1] and "related_" not in seen[-1] and "driver_r30" not in seen[-1]


def test_shuffled_vendors_follow_the_hashes(spark):
    rows = [(m, "food", o % 7, o * 31 % 11, o) for o in range(400) for m in ("SG", "US")[o % 3 == 0 :][:1]]
    here = spark.createDataFrame([(*r, sum(x[0] == r[0] and x[4] <= r[4] for x in rows)) for r in rows], "market string, vertical string, user_id long, vendor_id long, order_id long, _k long")
    got = {x.order_id: x.vendor_id for x in graph.shuffled(here, 3).collect()}
    for m in ("SG", "US"):
        mine = sorted((r for r in rows if r[0] == m), key=lambda r: r[4])
        dealt = sorted(mine, key=lambda r: (hashlib.md5(f"{r[4]}|3".encode()).hexdigest(), r[4]))
        assert [got[r[4]] for r in mine] == [r[3] for r in dealt]


def test_null_threshold_ranks_classes_of_edges(spark, monkeypatch):
    sizes, real = [], graph.quantiles
    monkeypatch.setattr(graph, "quantiles", lambda df, *rest: (sizes.append(df.count()), real(df, *rest))[1])
    rows = spark.range(600).select(F.lit("SG").alias("market"), F.lit("food").alias("vertical"), (F.col("id") % 50).alias("user_id"), (F.col("id") % 12).alias("vendor_id"), F.col("id").alias("order_id"), (F.col("id") % 4 == 0).cast("int").alias("is_refund"))
    assert graph.null_threshold(rows).first().null_threshold is not None and sizes[0] < 60


LOG = "order_id long, _s long, user_id long, driver_id long, vendor_id long, device_id long, market string, vertical string, status string, user_days_since_signup double, abuse_score double, fraud_score double"


def score_log(spark):
    rows = [(i, 1704067200 + i * 3600, i % 3, i % 2, 1, i % 4, "SG", "food", "delivered" if i % 2 else "placed", 50.0, float(i * 13 % 101), float(i * 7 % 103)) for i in range(60)]
    return spark.createDataFrame(rows, LOG).withColumn("event_ts", F.timestamp_seconds("_s")).drop("_s")


def test_served_orders_and_log_share_their_windows(spark):
    """The states of the log are computed once, in the pass that asks for them."""
    df = score_log(spark)
    out = serving.gated(df.where("order_id % 5 = 0"), df)
    # cohorts are looked up once, and keys without a join
    assert plan(out).count("FlatMapGroupsInArrow") == 1 and joins(out) <= 4


def test_head_ladders_ask_for_no_feature(spark, sf):
    text = plan(registry.queries()["served_head_tiers"](spark, sf))
    assert "reason_repeat" not in text and joins(registry.queries()["served_head_tiers"](spark, sf)) <= 4


def test_standing_states_follow_the_log(spark):
    log = score_log(spark)
    orders = log.where("order_id % 5 = 0")
    keys = scoring.entity_keys(orders)
    values = ("baseline_mean", "is_clean", "elevated_streak")
    got = {(r.order_id, r.entity_key): r for r in baselines.baselines_as_of(keys, baselines.observations_of(log)).collect()}
    states = baselines.baseline_history(baselines.settled_observations(scoring.entity_keys(log)))
    want = {(r.order_id, r.entity_key): r for r in serving.last_states(keys, states, baselines.KEY, list(values)).collect() if r.baseline_mean is not None}
    assert got.keys() == want.keys() and len(got) > 50
    assert all(tuple(got[k][v] for v in values) == tuple(want[k][v] for v in values) for k in want)
    cohorts = {(r.order_id, r.score_head): (r.cohort_n, r.cohort_p50) for r in baselines.cohorts_as_of(orders, log, block=7).collect()}
    found = serving.last_states(baselines.cohort_rows(orders, settled=False), baselines.cohort_history(log, block=20), baselines.COHORT, ["cohort_n", "cohort_p50"])
    assert cohorts == {(r.order_id, r.score_head): (r.cohort_n, r.cohort_p50) for r in found.collect() if r.cohort_n is not None}


def test_an_order_that_the_log_holds_twice_counts_once_for_each_key(spark):
    log = score_log(spark)
    twice = log.unionByName(log.where("order_id = 31").withColumn("driver_id", F.lit(9).cast("long")))
    want = baselines.settled_observations(scoring.entity_keys(twice)).groupBy("order_id", "entity_key").count()
    got = baselines.observations_of(twice).groupBy("order_id", "entity_key").count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_last_scores_of_a_cohort_leave_out_nulls_and_put_nan_last(spark):
    log = score_log(spark).where("order_id < 12").withColumn("abuse_score", F.when(F.col("order_id") == 3, None).when(F.col("order_id") == 5, float("nan")).otherwise(F.col("abuse_score")))
    got = [(r.cohort_n, r.cohort_p50) for r in baselines.cohort_history(log, baselines.D.BASELINE | {"cohort_events": 3}, block=2).where("score_head = 'abuse'").orderBy("order_id").collect()]
    # 13, null, nan, 91, 16, 42
    assert len(got) == 6 and [n for n, _ in got][:4] == [1, 1, 2, 2] and got[0] == (1, 13.0) and got[2][1] != got[2][1] and got[5] == (3, 42.0)


def test_edges_as_of_orders_read_a_settled_history(spark, sf):
    """Which rows count is settled once, and orders carry what they have: of joins there are the own rows, and the totals before."""
    orders, hist = (registry_view(spark, sf, n) for n in ("ord", "hist"))
    for grain in ("order", "day"):
        out = graph.edge_as_of(orders, hist, grain)
        assert joins(out) <= 3 and "row_number" not in plan(out)


def test_evidence_is_not_interpreted(spark, sf):
    """No lambda over an array that the scores go into: Spark would interpret them for each row."""
    cols = {c: F.lit(1.0) for c in {m for _, m, _ in scoring.D.EVIDENCE} | {f"{k}_score" for k in ("user", "driver", "vendor")}}
    out = spark.range(1).withColumns(cols).select(scoring.evidence_items().alias("evidence"))
    assert "lambda" not in plan(out)
    codes = spark.range(1).withColumns({c: F.lit(0.0) for c in cols} | {"user_score": F.lit(95.0), "user_refund_rate_30d": F.lit(0.15), "driver_score": F.lit(None).cast("double")}).select(scoring.evidence_items().alias("evidence")).first().evidence
    assert [x.code for x in codes] == ["USER_REFUND_RATE_30D", "ENTITY_USER_EXTREME"]
