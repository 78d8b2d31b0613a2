"""Streams end in what the batch gives: values over shuffled micro-batches, last days and late rows included."""

import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from claimlens.functions.signals import normalize_sdk
from claimlens.operators import baselines as B
from claimlens.operators import evaluation, pit, scoring, serving
from claimlens.plans import serving_queries as SQ
from claimlens.sources.views import view
from claimlens.streaming import jobs, state
from claimlens.streaming.deltas import Deltas


def in_batches(spark, df, path, order, n=4):
    """df as a stream of n files in the given order; a later file has some of an earlier one's rows again if `order` says so."""
    rows = order(df.collect())
    size = -(-len(rows) // n)
    for i in range(0, len(rows), size):
        spark.createDataFrame(rows[i : i + size], df.schema).coalesce(1).write.mode("append").parquet(str(path))
        # files are taken by their time
        for f in sorted(os.listdir(path)):
            if f.endswith(".parquet") and not os.path.exists(f"{path}/.{f}.seen"):
                open(f"{path}/.{f}.seen", "w").close()
                os.utime(f"{path}/{f}", (1e9 + i, 1e9 + i))
    return jobs.read(spark, str(path), df.schema)


def shuffled(rows):
    rows = list(rows)
    random.Random(11).shuffle(rows)
    return rows


def nearly_sorted(rows):
    """By time, but for swaps within some hours, and a tenth of the rows once more."""
    rng = random.Random(7)
    again = [r for r in rows if rng.random() < 0.1]
    return sorted([*rows, *again], key=lambda r: r.event_ts.timestamp() + rng.random() * 20 * 3600)


def with_end(spark, df, **key):
    """df and a row of another key years later: it moves the watermark past the last rows."""
    last = df.limit(1).withColumns({k: F.lit(v) for k, v in key.items()}).withColumn("event_ts", F.lit("2034-01-01").cast("timestamp"))
    return df.unionByName(last.select(*df.columns))


def told(rows, cols):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in cols)) for r in rows)


def test_sdk_latest_equals_batch(spark, sf, tmp_path):
    sdk = view(spark, sf, "sdk").withColumn("confidence", F.col("confidence").cast("double"))
    stream = in_batches(spark, sdk, tmp_path / "in", shuffled)
    jobs.sdk_latest(stream, str(tmp_path / "out"), str(tmp_path / "cp"), every=3).awaitTermination()
    accepted = normalize_sdk(sdk).where("accepted")
    want = scoring.latest(accepted, ["order_id", "source"], [F.col("event_ts").desc(), F.col("confidence").desc()])
    got = jobs.latest_signals(str(tmp_path / "out"), jobs._ddl(accepted)).read(spark)
    assert told(got.collect(), want.columns) == told(want.collect(), want.columns)


LEDGER = "k long, v double, event_ts timestamp"


def test_deltas_are_idempotent_and_grow_with_the_batch(spark, tmp_path):
    """Every batch again, and compactions again: nothing changes; files written by a batch don't grow with the table."""
    rows = spark.range(4000).select((F.col("id") % 700).alias("k"), (F.col("id") * 1.0).alias("v"), F.timestamp_seconds(F.col("id") * 37 % 4001).alias("event_ts"))
    table = Deltas(str(tmp_path / "t"), LEDGER, ["k"], [F.col("event_ts").desc(), F.col("v").desc()], buckets=4, every=3)
    parts = [rows.where(F.col("v") % 10 == i) for i in range(10)]
    sizes = []
    for n, part in enumerate(parts):
        table.write(part, n)
        sizes.append(sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(tmp_path / f"t/delta/batch={n}") for f in fs if f.endswith(".parquet")))
        table.write(part, n)
    want = told(scoring.latest(rows, ["k"], [F.col("event_ts").desc(), F.col("v").desc()]).collect(), ["k", "v"])
    assert told(table.read(spark).collect(), ["k", "v"]) == want
    assert max(sizes) < 1.5 * min(sizes)
    table.write(parts[8], 8)  # a batch that was compacted already
    table.compact(spark, 8)
    assert told(table.read(spark).collect(), ["k", "v"]) == want
    early = rows.where("v % 10 < 4")
    assert told(table.read(spark, below=4).collect(), ["k", "v"]) == told(scoring.latest(early, ["k"], [F.col("event_ts").desc(), F.col("v").desc()]).collect(), ["k", "v"])


def test_what_is_idle_can_be_removed(spark, tmp_path):
    """Twenty batches with a vacuum after each: the table is whole, and its files don't pile up; a merge that broke off is read right."""
    rows = spark.range(2000).select((F.col("id") % 300).alias("k"), (F.col("id") * 1.0).alias("v"), F.timestamp_seconds(F.col("id") * 37 % 2003).alias("event_ts"))
    table = Deltas(str(tmp_path / "t"), LEDGER, ["k"], [F.col("event_ts").desc(), F.col("v").desc()], buckets=2, every=3)
    for n in range(14):
        table.write(rows.where(F.col("v") % 14 == n), n)
        table.vacuum(spark)
    assert len(table._numbers(spark, "delta", 99)) <= 6 and all(len(table._numbers(spark, f"base/bucket={b}", 99)) <= 2 for b in range(2))
    want = told(scoring.latest(rows, ["k"], [F.col("event_ts").desc(), F.col("v").desc()]).collect(), ["k", "v"])
    assert told(table.read(spark).collect(), ["k", "v"]) == want
    # the next merge gets through one bucket only
    shutil.copytree(tmp_path / "t", tmp_path / "broken")
    table.compact(spark, 13)
    shutil.copytree(tmp_path / "t/base/bucket=1/upto=13", tmp_path / "broken/base/bucket=1/upto=13")
    broken = Deltas(str(tmp_path / "broken"), LEDGER, table.key, table.first, buckets=2, every=3)
    assert told(broken.read(spark).collect(), ["k", "v"]) == want
    broken.compact(spark, 13)
    assert told(broken.read(spark).collect(), ["k", "v"]) == want == told(table.read(spark).collect(), ["k", "v"])


def test_sums_are_merged_on_read(spark, tmp_path):
    table = Deltas(str(tmp_path / "t"), "k long, n long, late long, at long", ["k"], sums=("n", "late"), most=("at",), buckets=2, every=2)
    assert table.read(spark).collect() == []
    for n in range(5):
        table.write(spark.createDataFrame([(1, n, 1, 9 - n), (1, 1, 0, 0), (n + 2, 5, 0, n)], table.schema), n)
    got = {r.k: (r.n, r.late, r.at) for r in table.read(spark).collect()}
    assert got == {1: (15, 5, 9), **{n + 2: (5, 0, n) for n in range(5)}}


def test_daily_rate_equals_batch_on_all_days(spark, sf, tmp_path):
    hist = view(spark, sf, "hist").select("event_ts", "market", "vertical", "is_refund")
    stream = in_batches(spark, hist, tmp_path / "in", lambda rows: sorted(rows, key=lambda r: r.event_ts))
    jobs.daily_segment_rate(stream, str(tmp_path / "out"), str(tmp_path / "cp"), every=2).awaitTermination()
    rows = jobs.daily_rates(str(tmp_path / "out")).read(spark).collect()
    want = {(r.segment, r.day): (r.n, r.refund_rate) for r in evaluation.daily_refund_series(hist, 1).collect()}
    got = {(r.segment, r.day): (r.n, r.refunds / r.n) for r in rows}
    assert set(got) == set(want) and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)
    assert sum(r.late for r in rows) == 0


def test_late_rows_are_counted_apart(spark, sf, tmp_path):
    """Shuffled over a month, most rows come after their day has closed: on time and late together are all rows."""
    hist = view(spark, sf, "hist").select("event_ts", "market", "vertical", "is_refund")
    rows = shuffled(hist.collect())
    stream = in_batches(spark, hist, tmp_path / "in", lambda _: rows, 4)
    jobs.daily_segment_rate(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "2 days").awaitTermination()
    got = {(r.segment, r.day): (r.n, r.late) for r in jobs.daily_rates(str(tmp_path / "out")).read(spark).collect()}
    size, want, mark = -(-len(rows) // 4), {}, None
    for i in range(0, len(rows), size):
        part = rows[i : i + size]
        for r in part:
            key = f"{r.market.upper()}|{r.vertical.lower()}", r.event_ts.date()
            closed = mark is not None and (mark - r.event_ts.replace(hour=0, minute=0, second=0, microsecond=0)).total_seconds() >= 3 * 86400
            n, late = want.get(key, (0, 0))
            want[key] = (n, late + 1) if closed else (n + 1, late)
        mark = max([r.event_ts for r in part] + ([mark] if mark else []))
    assert got == want and sum(x[1] for x in want.values()) > 100


@pytest.fixture(scope="module")
def log(spark, sf):
    return SQ.score_log(spark, sf)


def test_baseline_states_equal_the_windows(spark, log, tmp_path):
    seen = B.settled_observations(scoring.entity_keys(log)).where("entity_kind in ('user', 'uv')")
    seen = seen.select("order_id", "entity_kind", "entity_key", "market", "vertical", "score_head", "score", "support", "event_ts")
    want = B.baseline_history(seen).collect()
    stream = in_batches(spark, with_end(spark, seen, entity_key="end"), tmp_path / "in", nearly_sorted)
    state.baseline_states(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "2 days").awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    cols = [x.split()[0] for x in state.BASELINE_OUT.split(", ")]
    assert told(got, cols) == told(want, cols) and len(want) > 100


def test_cohort_states_equal_the_windows(spark, log, tmp_path):
    rows = B.cohort_history(log, block=50)
    seen = rows.select("order_id", "market", "vertical", "tenure_bucket", "score_head", "score", "event_ts")
    stream = in_batches(spark, with_end(spark, seen, market="end"), tmp_path / "in", nearly_sorted)
    state.cohort_states(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "2 days").awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    cols = [x.split()[0] for x in state.COHORT_OUT.split(", ")]
    assert told(got, cols) == told(rows.collect(), cols)


def test_rolling_rates_equal_the_windows(spark, sf, tmp_path):
    hist = view(spark, sf, "hist").select("user_id", "order_id", "event_ts", "is_refund", "cents")
    want = pit.window_sums(hist, hist, {f"{n}_{d}d": (["user_id"], d, m) for d in (7, 30) for n, m in (("orders", "n"), ("refunds", "r"))})
    stream = in_batches(spark, with_end(spark, hist, user_id=-1), tmp_path / "in", nearly_sorted)
    state.rolling_refund_rate(stream, "user_id", str(tmp_path / "out"), str(tmp_path / "cp"), "2 days").awaitTermination()
    cols = ["order_id", "orders_7d", "refunds_7d", "orders_30d", "refunds_30d"]
    assert told(spark.read.parquet(str(tmp_path / "out")).collect(), cols) == told(want.collect(), cols)


def test_seen_orders_are_forgotten(spark, tmp_path):
    """One key, a row an hour for 90 days: what the key remembers stays within the days kept."""
    rows = spark.range(90 * 24).select(F.lit("k").alias("entity"), F.col("id").alias("order_id"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 3600).alias("event_ts"), F.lit(1).alias("is_refund"))
    stream = in_batches(spark, with_end(spark, rows.withColumn("entity", F.lit("k")), entity="end"), tmp_path / "in", lambda x: sorted(x, key=lambda r: r.event_ts), 5)
    state.rolling_refund_rate(stream, "entity", str(tmp_path / "out"), str(tmp_path / "cp"), "1 day").awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 90 * 24 and out.agg(F.max("orders_30d")).first()[0] == 30 * 24
    kept = spark.read.format("statestore").option("path", str(tmp_path / "cp")).option("stateVarName", "seen").load().where("key.entity = 'k'").count()
    assert kept <= (state.KEEP_DAYS + 1) * 24


def test_archive_holds_each_snapshot_once(spark, sf, tmp_path):
    from claimlens.plans import score_queries as S

    scoring.snapshots(S.scored(spark, sf)).repartition(2).write.parquet(str(tmp_path / "snaps"))
    back = spark.read.parquet(str(tmp_path / "snaps"))
    for _ in range(2):  # a second run finds nothing new
        jobs.archive(jobs.read(spark, str(tmp_path / "snaps"), back.schema), str(tmp_path / "log"), str(tmp_path / "log_cp")).awaitTermination()
    log = spark.read.parquet(str(tmp_path / "log"))
    cols = ["order_id", "tier", "decision_score", "reason_codes_json"]
    assert told(log.collect(), cols) == told(scoring.archive_rows(back).collect(), cols)


@pytest.fixture(scope="module")
def scored(spark, sf):
    from claimlens.plans.feature_queries import features
    from claimlens.sources.tables import written

    return written(SQ.with_fixed_scores(features(spark, sf).withColumn("uv_mo_possible_collusion", F.lit(0.0))))


COLS = ["order_id", "event_ts", "status", "settled", "abuse_score", "fraud_score", "decision_score", "tier", "final_effect"]


def test_lifecycle_refresh_decides_by_the_last_event(spark, log, scored, tmp_path):
    """Orders placed, then delivered an hour later: the table holds the decision of the last event, as the batch form gives it."""
    some = scored.where("order_id % 25 = 0").select("order_id", "event_ts")
    events = some.select("order_id", "event_ts", F.lit("placed").alias("status")).unionByName(some.where("order_id % 50 = 0").select("order_id", (F.col("event_ts") + F.expr("INTERVAL 1 HOUR")).alias("event_ts"), F.lit("delivered").alias("status")))
    stream = in_batches(spark, events, tmp_path / "in", lambda rows: sorted(rows, key=lambda r: (r.status == "delivered", r.event_ts)), 2)
    jobs.lifecycle_refresh(stream, scored, log, str(tmp_path / "out"), str(tmp_path / "cp"), every=2).awaitTermination()
    got = jobs.served_orders(str(tmp_path / "out"), jobs.SERVED).read(spark).collect()
    last = scoring.latest(events, ["order_id"], [F.col("event_ts").desc()]).collect()
    assert {(r.order_id, r.event_ts, r.status, r.settled) for r in got} == {(r.order_id, r.event_ts, r.status, r.status == "delivered") for r in last} and any(r.settled for r in got)
    # judged one by one in batch
    one = next(r for r in got if r.settled)
    row = scored.where(F.col("order_id") == one.order_id).drop("status", "event_ts").withColumns({"status": F.lit("delivered"), "event_ts": F.lit(one.event_ts)})
    whole = log.where(F.col("order_id") != one.order_id).unionByName(row.select(*[c for c in log.columns if c in row.columns]), allowMissingColumns=True)
    assert told(serving.serve(row, whole).withColumn("settled", F.lit(True)).collect(), COLS) == told([one], COLS)


def test_rescoring_decides_touched_orders_anew(spark, log, scored, tmp_path):
    keys = scoring.entity_keys(scoring.with_entity_scores(scored))
    early = F.col("event_ts") < F.lit("2024-01-22").cast("timestamp")
    standing, new = scoring.standing_scores(keys.where(early)), scoring.standing_scores(keys.where(~early))
    new.coalesce(1).write.parquet(str(tmp_path / "new"))
    opened = scored.where("event_ts >= '2024-01-22' and status = 'placed'")
    stream = jobs.read(spark, str(tmp_path / "new"), new.schema)
    jobs.rescoring(stream, opened, standing, log, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    touched = scoring.touched_orders(scoring.entity_keys(opened), standing, new)
    rows = opened.join(touched, "order_id", "left_semi").withColumn("status", F.lit("claim"))
    before = log.join(touched, "order_id", "left_anti").unionByName(rows.select(*[c for c in log.columns if c in rows.columns]), allowMissingColumns=True)
    got = jobs.served_orders(str(tmp_path / "out"), jobs.SERVED).read(spark).collect()
    assert got and told(got, COLS) == told(jobs.served(rows, before).collect(), COLS)
