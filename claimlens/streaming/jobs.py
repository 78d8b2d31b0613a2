"""Structured Streaming forms of the risk operators; an `availableNow` run over a finite input ends in what the batch gives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimlens.functions.signals import normalize_sdk
from claimlens.operators import scoring, serving
from claimlens.streaming.deltas import Deltas


def read(spark: SparkSession, path: str, schema, form: str = "parquet", files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(form).load(path)


def _run(writer, checkpoint: str) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def latest_signals(path: str, schema: str, every: int = 8) -> Deltas:
    """The table of the latest accepted signal per order and source."""
    return Deltas(path, schema, ["order_id", "source"], [F.col("event_ts").desc(), F.col("confidence").desc()], every=every)


def sdk_latest(events: DataFrame, path: str, checkpoint: str, every: int = 8) -> StreamingQuery:
    """Latest accepted signal per order and source, as deltas that are merged on read (`latest_signals(...).read`): an older
    event never replaces a newer one, and a repeated event or micro-batch changes nothing."""
    accepted = normalize_sdk(events).where("accepted")
    table = latest_signals(path, _ddl(accepted), every)
    return _run(accepted.writeStream.foreachBatch(lambda batch, number: table.write(batch, number)), checkpoint)


#: Orders and refunds of a segment and day, rows that came too late for it, and the last event time of the batches.
DAILY = "segment string, day date, n long, refunds long, late long, last_ts timestamp"


def daily_rates(path: str, every: int = 8) -> Deltas:
    return Deltas(path, DAILY, ["segment", "day"], sums=("n", "refunds", "late"), most=("last_ts",), every=every)


def daily_segment_rate(history: DataFrame, path: str, checkpoint: str, delay: str = "1 day", every: int = 8) -> StreamingQuery:
    """Orders and refunds per segment and day, complete up to the last event: each micro-batch adds its counts.

    A row is late if its day had ended `delay` before the last event of the micro-batches before it; late rows are counted
    apart and change no rate."""
    table = daily_rates(path, every)

    def add(batch: DataFrame, number: int) -> None:
        # a batch that is repeated sees what it saw the first time
        mark = table.read(batch.sparkSession, number).agg(F.max("last_ts").alias("_mark"))
        rows = batch.where("event_ts is not null").select(F.concat_ws("|", F.upper("market"), F.lower("vertical")).alias("segment"), F.to_date("event_ts").alias("day"), "event_ts", "is_refund").crossJoin(F.broadcast(mark))
        late = F.coalesce(F.date_add("day", 1).cast("timestamp") <= F.col("_mark") - F.expr(f"INTERVAL {delay}"), F.lit(False))
        rows = rows.withColumn("_late", late.cast("long"))
        counts = rows.groupBy("segment", "day").agg(F.sum(1 - F.col("_late")).alias("n"), F.sum(F.when(F.col("_late") == 0, F.col("is_refund")).otherwise(0)).cast("long").alias("refunds"), F.sum("_late").alias("late"), F.max("event_ts").alias("last_ts"))
        table.write(counts, number)

    return _run(history.writeStream.foreachBatch(add), checkpoint)


def archive(snapshots: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append snapshots to the decision archive, each once."""
    return _run(scoring.archive_rows(snapshots).writeStream.outputMode("append").format("parquet").partitionBy("day").option("path", path), checkpoint)


def served_orders(path: str, schema: str, every: int = 8) -> Deltas:
    """The table of each order's last decision, by the time of its lifecycle event."""
    return Deltas(path, schema, ["order_id"], [F.col("event_ts").desc()], every=every)


SERVED = "order_id bigint, event_ts timestamp, status string, settled boolean, abuse_score double, fraud_score double, decision_score double, tier string, final_effect string, baseline_codes array<string>"


def served(orders: DataFrame, log: DataFrame) -> DataFrame:
    """Orders with features and scores, decided with the baseline gate over the score log."""
    settled = F.lower("status").isin("delivered", "claim", "refunded", "completed")
    return serving.serve(orders, log).withColumn("settled", settled).select(*[c.split()[0] for c in SERVED.split(", ")])


def lifecycle_refresh(order_events: DataFrame, features: DataFrame, log: DataFrame, path: str, checkpoint: str, every: int = 8) -> StreamingQuery:
    """Each lifecycle event (order_id, event_ts, status) joined to the order's scored features and decided anew. A settled event
    counts in the baselines it is judged by, with the score log (settled orders before it); the last event of an order in a
    micro-batch is the one that is decided. The table of decisions is `served_orders(...).read`."""
    table = served_orders(path, SERVED, every)

    def decide(batch: DataFrame, number: int) -> None:
        last = scoring.latest(batch, ["order_id"], [F.col("event_ts").desc()])
        rows = last.join(features.drop("status", "event_ts"), "order_id")
        own = rows.select("order_id")
        before = log.join(own, "order_id", "left_anti")
        table.write(served(rows, before.unionByName(rows.select(*[c for c in log.columns if c in rows.columns]), allowMissingColumns=True)), number)

    return _run(order_events.writeStream.foreachBatch(decide), checkpoint)


def rescoring(new_scores: DataFrame, open_orders: DataFrame, standing: DataFrame, log: DataFrame, path: str, checkpoint: str, every: int = 8) -> StreamingQuery:
    """Open orders (features and scores) that share a key whose score has moved are decided again, batch by batch, as claims;
    the table of decisions is `served_orders(...).read`."""
    table = served_orders(path, SERVED, every)
    keys = scoring.entity_keys(open_orders)

    def decide(batch: DataFrame, number: int) -> None:
        touched = scoring.touched_orders(keys, standing, batch)
        rows = open_orders.join(touched, "order_id", "left_semi").withColumn("status", F.lit("claim"))
        before = log.join(touched, "order_id", "left_anti")
        table.write(served(rows, before.unionByName(rows.select(*[c for c in log.columns if c in rows.columns]), allowMissingColumns=True)), number)

    return _run(new_scores.writeStream.foreachBatch(decide), checkpoint)
