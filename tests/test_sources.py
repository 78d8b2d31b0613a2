"""Readers and small helpers on literal files and rows."""

import json
import os

import pytest
from pyspark.sql import functions as F

from claimlens.functions import signals
from claimlens.operators import evaluation, labels, pit, scoring
from claimlens.plans import feature_queries, service_queries
from claimlens.sources import views
from claimlens.sources.tables import there


def test_core_scan_reads_csv_under_its_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text("order_id,amount,market\n1,2.5,SG\n2,,\n")
    got = views.core_scan(spark, str(tmp_path / "a.csv"), "order_id long, amount double, market string").collect()
    assert [tuple(r) for r in got] == [(1, 2.5, "SG"), (2, None, None)]
    spark.range(3).write.parquet(str(tmp_path / "p"))
    assert views.core_scan(spark, str(tmp_path / "p"), "id long", "parquet").count() == 3


def test_missing_columns_get_defaults_or_are_named(spark):
    df = views.ensure_columns(spark.createDataFrame([(1, "x")], "a int, b string"), {"a": 9, "c": 0.5})
    assert tuple(df.first()) == (1, "x", 0.5)
    views.require_columns(df, ["a", "c"])
    with pytest.raises(ValueError, match="d, e"):
        views.require_columns(df, ["a", "d", "e"])


def test_blanks_become_null(spark):
    df = spark.createDataFrame([("  ", float("nan"), 1), ("x ", 2.0, 2), (None, None, 3)], "s string, d double, i int")
    assert [tuple(r) for r in views.blanks_to_null(df).orderBy("i").collect()] == [(None, None, 1), ("x ", 2.0, 2), (None, None, 3)]


def test_newest_file_by_time_then_path(spark, tmp_path):
    for i, name in enumerate(("b", "a", "c")):
        spark.range(i, i + 1).coalesce(1).write.parquet(str(tmp_path / name))
        for f in os.listdir(tmp_path / name):
            os.utime(tmp_path / name / f, (2e9 if name != "c" else 1e9,) * 2)
    df = views.newest_file(spark, str(tmp_path / "*"))
    assert [r.id for r in df.collect()] == [0]  # a and b are of one time: the larger path counts


def test_there(spark, tmp_path):
    assert there(spark, str(tmp_path)) and not there(spark, str(tmp_path / "no"))


def test_envelopes_from_files(spark, tmp_path):
    one = {"order_id": "7", "source": "shield", "confidence": 0.9, "event_ts": "2024-01-01 00:00:00", "payload": {"risk_score": 40}}
    (tmp_path / "x.jsonl").write_text(json.dumps(one) + "\nno json\n" + json.dumps({"events": [one | {"order_id": "8"}]}) + "\n" + json.dumps(one | {"order_id": ""}) + "\n")
    assert sorted(r.order_id for r in signals.read_envelopes(spark, str(tmp_path / "x.jsonl")).collect()) == ["7", "8"]
    assert signals.read_envelopes(spark, str(tmp_path), stream=True).isStreaming


def test_payloads_lie_under_the_orders_own_values(spark):
    rows = spark.createDataFrame([(1, 0.0, {"risk_score": 0.4}), (2, 55.0, {"risk_score": 0.4}), (3, None, None)], "order_id int, device_risk_score double, p map<string,double>")
    out = {r.order_id: r for r in signals.merge_signals(rows, device=F.col("p")).collect()}
    assert (out[1].device_risk_score, out[2].device_risk_score, out[3].device_risk_score) == (40.0, 55.0, 0.0)
    assert signals.merge_signals(rows).columns == rows.columns


def test_bands_and_gate(spark):
    df = spark.createDataFrame([(25.0, 0.0), (25.1, 0.0), (75.0, 0.0), (75.1, 0.0), (1.0, 1.0)], "decision_score double, prior_strong_fraud double")
    df = df.withColumns({"abuse_score": F.lit(0.0), "fraud_score": F.lit(0.0), "soft_friction": F.lit(1.0), "hold_review": F.lit(2.0), "auto_deny": F.lit(3.0)})
    got = [(r.tier, r.combined_score) for r in scoring.with_decision(df, "score_only").orderBy("prior_strong_fraud", "decision_score").collect()]
    assert [t for t, _ in got] == ["auto_approve", "soft_friction", "hold_review", "auto_deny", "auto_deny"] and got[-1][1] == 90.0


def test_claim_and_delivery_columns_are_clamped(spark):
    rows = spark.createDataFrame([("2", 7.0, "x"), ("nan", -1.0, "1")], "claim_has_image string, claim_image_ai_risk double, pin_required string")
    out = [tuple(r) for r in rows.select(*[c.alias(n) for n, c in pit.claim_delivery(rows).items()]).select("claim_has_image", "claim_image_ai_risk", "pin_required", "pin_verified").collect()]
    assert out == [(1.0, 1.0, 0.0, 0.0), (0.0, 0.0, 1.0, 0.0)]


def test_too_few_proven_labels_stop_training(spark):
    rows = spark.createDataFrame([(1, "proven", 1), (2, "", 0)], "order_id int, fraud_label_source string, fraud_label int")
    labels.require_proven(rows, 1)
    with pytest.raises(ValueError, match="1 proven labels, 2 asked for"):
        labels.require_proven(rows, 2)


def test_replay_finds_no_difference(spark, sf):
    got = service_queries.replay(spark, sf).collect()
    assert len(got) > 50 and all(r.n_different == 0 and r.n_orders > 50 for r in got)


def test_drawn_weights_are_poisson(spark):
    """Over many rows and turns: the mean and variance of a Poisson weight are 1, and rounds are not alike."""
    u = evaluation.draw(F.col("id"), F.col("r")) / float(evaluation.PRIME)
    w = sum([(u >= x).cast("int") for x in evaluation.poisson_steps()], F.lit(0))
    rows = spark.range(2000).select("id", F.explode(F.sequence(F.lit(1), F.lit(50))).alias("r")).withColumn("w", w)
    mean, var = rows.agg(F.avg("w"), F.var_pop("w")).first()
    sums = rows.groupBy("r").agg(F.sum("w").alias("s")).agg(F.var_pop("s")).first()[0]
    assert abs(mean - 1) < 0.02 and abs(var - 1) < 0.05 and 1000 < sums < 3600


def test_features_read_like_views(spark, sf):
    assert {len(t.columns) for t in feature_queries.tables(spark, sf)} and views.query_source(spark, "SELECT count(*) AS n FROM {x}", x=spark.range(4)).first().n == 4
