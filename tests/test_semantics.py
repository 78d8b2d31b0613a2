"""Small literal cases of the risk operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimlens.functions import signals
from claimlens.operators import evaluation, labels, pit, scoring

T = dt.datetime(2024, 1, 1)
HISTORY = "order_id string, user_id string, driver_id string, vendor_id string, cents long, is_refund int, event_ts timestamp"


def day(n):
    return T + dt.timedelta(days=n)


def test_own_order_and_future_rows_do_not_count(spark):
    rows = [("a", "u", "d", "v", 5000, 1, day(1)), ("b", "u", "d", "v", 5000, 1, day(2)), ("c", "u", "d", "v", 5000, 0, day(3)), ("o", "u", "d", "v", 900, 1, day(4)), ("z", "u", "d", "v", 100, 1, day(9))]
    history = spark.createDataFrame(rows, HISTORY)
    orders = history.where("order_id = 'o'")
    got = pit.user_windows(orders, history).first()
    assert (got.user_n30, got.user_r30, got.life_g, got.life_rg) == (3, 2, 15000, 10000)
    base = pit.base_rate(orders, history).first()
    assert (base.base_n, base.base_r, base.base_rate) == (3, 2, 0.5)


def test_window_holds_both_ends(spark):
    rows = [("a", "u", "d", "v", 1, 0, day(0)), ("o", "u", "d", "v", 1, 0, day(30)), ("p", "u", "d", "v", 1, 0, day(31))]
    history = spark.createDataFrame(rows, HISTORY)
    got = {r.order_id: r.user_n30 for r in pit.user_windows(history.where("order_id in ('o', 'p')"), history).collect()}
    assert got == {"o": 1, "p": 1}


def test_no_history_gives_defaults(spark):
    empty = spark.createDataFrame([], HISTORY)
    orders = spark.createDataFrame([("o", "u", "d", "v", 1, 0, day(0))], HISTORY)
    assert pit.base_rate(orders, empty).first().base_rate == 0.05
    assert pit.user_windows(orders, empty).first().user_n30 == 0


def test_latest_disposition_hides_older_even_if_too_early(spark):
    orders = spark.createDataFrame([("a", day(0)), ("b", day(0))], "order_id string, event_ts timestamp")
    rows = [("a", "chargeback_lost", day(8)), ("b", "chargeback_lost", day(8)), ("b", "investigator_cleared", day(9))]
    got = {r.order_id: (r.fraud_label, r.disposition_state) for r in labels.apply_dispositions(orders, spark.createDataFrame(rows, "order_id string, disposition string, disposition_ts timestamp")).collect()}
    assert got == {"a": (1, "applied"), "b": (0, "applied")}
    early = spark.createDataFrame([("a", "chargeback_lost", day(8)), ("a", "investigator_cleared", day(20))], "order_id string, disposition string, disposition_ts timestamp")
    assert labels.apply_dispositions(orders, early, as_of=day(10)).where("order_id = 'a'").first().fraud_label == 1


def test_most_specific_overlay_wins(spark):
    df = spark.createDataFrame([("SG", "food"), ("SG", "x"), ("Z", "food"), ("Z", "x")], "market string, vertical string")
    over = [("", "food", (1.0, 2.0, 3.0)), ("SG", "", (4.0, 5.0, 6.0)), ("SG", "food", (7.0, 8.0, 9.0)), ("SG", "food", (0.0, 0.0, 0.0))]
    got = {(r.market, r.vertical): r.soft_friction for r in scoring.with_thresholds(df, overlays=over).collect()}
    assert got == {("SG", "food"): 7.0, ("SG", "x"): 4.0, ("Z", "food"): 1.0, ("Z", "x"): 35.0}


def test_shadow_rule_stops_the_search(spark):
    rules = [{"id": "s", "mode": "shadow", "when": {}, "effect": "refund_block", "reason": "S"}, {"id": "l", "mode": "live", "when": {}, "effect": "refund_step_up", "reason": "L"}]
    df = spark.createDataFrame([("hold_review", 60.0)], "tier string, decision_score double")
    got = scoring.with_effect(df, rules).first()
    assert (got.final_effect, got.shadow_effect, got.effect_reasons) == ("refund_manual_review", "refund_block", ["S", "EFFECT_SHADOW"])
    assert scoring.with_effect(df, rules, kill_switch=True).first().effect_reasons == ["EFFECT_KILL_SWITCH"]


def test_risk_of_one_means_hundred(spark):
    p = F.create_map(F.lit("risk_score"), F.lit("1"))
    assert spark.range(1).select(signals.device_signal(p)["device_risk_score"].alias("x")).first().x == 100.0


def test_infeasible_cut_is_null(spark):
    df = spark.createDataFrame([(10.0, 1)] + [(50.0, 0)] * 99, "s double, y int")
    got = evaluation.recommend_ladders(df, "s", "y").first()
    assert got.soft_cut is None and not got.promote


def test_perfect_ranking(spark):
    df = spark.createDataFrame([(90.0, 1), (80.0, 1), (10.0, 0), (5.0, 0)], "s double, y int")
    got = evaluation.ranking(df, "s", "y").first()
    assert (got.auc, got.average_precision) == (1.0, 1.0)


def test_missing_metric_fails_the_gate(spark):
    df = spark.createDataFrame([(0.1,)], "decision_ece double")
    got = {r.metric: r.reason for r in evaluation.monitoring_gate(df, {"decision_ece": 0.2, "hold_rate": 0.5}).collect()}
    assert got == {"hold_rate": "missing"}


@pytest.mark.parametrize("votes,label", [((1, 1, 0), 1), ((1, 0, None), -1), ((None, None, None), -1)])
def test_votes(spark, votes, label):
    df = spark.createDataFrame([("o",)], "order_id string")
    got = labels.weak_labels(df, {f"v{i}": F.lit(v).cast("int") for i, v in enumerate(votes)}).first()
    assert got.weak_label == label


def test_lookback_and_pruning_cut_the_history(spark):
    hist = spark.createDataFrame([(i, i % 4, day(i)) for i in range(20)], "order_id long, user_id long, event_ts timestamp")
    assert {r.order_id for r in labels.lookback(hist, 5).collect()} == {14, 15, 16, 17, 18, 19}
    assert {r.order_id for r in labels.lookback(hist, 5, day(10)).collect()} == {5, 6, 7, 8, 9, 10}
    devices = spark.createDataFrame([(1, 0), (1, 1), (2, 2), (3, 3)], "device_id long, user_id long")
    kept = labels.prune_history(hist, hist.where("order_id = 0"), devices)
    assert {r.user_id for r in kept.collect()} == {0, 1}
