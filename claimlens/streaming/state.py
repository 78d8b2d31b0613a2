"""States by key as streams, in the order of event time: baselines and cohorts as the batch windows of operators/baselines.py
give them, and exact rolling sums as those of operators/pit.py.

Rows wait in the key's buffer until the watermark has passed them, then they are taken by (event_ts, order_id), whatever
micro-batch brought them; rows behind the watermark are dropped. An order that a key has seen in the last KEEP_DAYS
changes nothing and gives no row; what was seen before is forgotten, so a key's state doesn't grow with its history.
A stream that ends needs a row with a later event time (of any key) to move the watermark past its last rows.
Needs the RocksDB state store."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from claimlens.functions import defaults as D
from claimlens.operators.baselines import COHORT, KEY

BASELINE_OUT = "entity_key string, market string, vertical string, order_id long, n_observations int, n_under int, under_rate double, baseline_mean double, baseline_p50 double, baseline_p90 double, under_streak long, elevated_streak long, is_clean boolean"
COHORT_OUT = "market string, vertical string, tenure_bucket string, score_head string, order_id long, cohort_n int, cohort_mean double, cohort_p50 double, cohort_p90 double"
ROLLING_OUT = "entity string, order_id long, orders_7d long, refunds_7d long, orders_30d long, refunds_30d long"
DAY = 86_400_000_000
KEEP_DAYS = 30


def marks(values: list[float]) -> tuple[float, float, float]:
    """Mean and positional p50 and p90."""
    ranked = sorted(values)
    return sum(values) / len(values), ranked[len(ranked) // 2], ranked[max(1, int(len(ranked) * 0.9)) - 1]


class Ordered(StatefulProcessor):
    """Takes a key's rows in the order of event time, each order_id once. Subclasses name the columns they wait for and
    say what a run of rows, in order, gives."""

    waits: dict[str, str] = {"score": "double"}
    out = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.names = ["t", "order_id", *self.waits]
        self.buffer = handle.getListState("buffer", "t long, order_id long, " + ", ".join(f"{k} {v}" for k, v in self.waits.items()))
        self.last = handle.getListState("last", "t long, score double")
        self.seen = handle.getMapState("seen", "order_id long", "t long")
        self.swept = handle.getValueState("swept", "day long")
        self.flags = handle.getValueState("flags", "under long, elevated long, clean boolean")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = []
        for part in rows:
            cols = [part[c].tolist() for c in self.waits]
            new += zip([t.value // 1000 for t in part["event_ts"]], part["order_id"].tolist(), *cols, strict=True)
        self.buffer.appendList(new)
        self.handle.registerTimer(min(t for t, *_ in new) // 1000)
        yield pd.DataFrame([], columns=self.columns())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(tuple(x) for x in self.buffer.get()) if self.buffer.exists() else []
        ripe, rest = [x for x in waiting if x[0] < upto], [x for x in waiting if x[0] >= upto]
        fresh = []
        for x in ripe:
            if not self.seen.containsKey((x[1],)):
                self.seen.updateValue((x[1],), (x[0],))
                fresh.append(dict(zip(self.names, x, strict=True)))
        if ripe:
            if rest:
                self.buffer.put(rest)
                self.handle.registerTimer(rest[0][0] // 1000)
            else:
                self.buffer.clear()
            self.sweep(upto)
        out = self.taken(key, fresh) if fresh else []
        yield pd.DataFrame(out, columns=self.columns())

    def sweep(self, upto: int) -> None:
        """Forget orders seen long ago, once a day of event time."""
        day = upto // DAY
        if not self.swept.exists() or self.swept.get()[0] < day:
            self.swept.update((day,))
            for old in [k for k, v in self.seen.iterator() if v[0] < upto - KEEP_DAYS * DAY]:
                self.seen.removeKey(tuple(old))

    def columns(self) -> list[str]:
        return [x.split()[0] for x in self.out.split(", ")]

    def taken(self, key: tuple, rows: list[dict]) -> list[tuple]:
        raise NotImplementedError


class Baselines(Ordered):
    waits = {"score": "double", "score_head": "string", "entity_kind": "string", "support": "double"}
    out = BASELINE_OUT

    def taken(self, key: tuple, rows: list[dict]) -> list[tuple]:
        c, out = D.BASELINE, []
        events = [tuple(x) for x in self.last.get()] if self.last.exists() else []
        under, elevated, clean = self.flags.get() if self.flags.exists() else (0, 0, False)
        for r in rows:
            t, score = r["t"], r["score"]
            events = [*events, (t, score)][-c["events"] :]
            limit = c["under_fraud"] if r["score_head"] == "fraud" else c["under_abuse"]
            scores = [s for at, s in events if at >= t - c["days"] * DAY]
            low = [s for s in scores if s < limit]
            mean, p50, p90 = marks(low or scores)
            rate = len(low) / len(scores)
            up = (score - mean >= c["delta"] or score / max(mean, 1e-6) >= c["lift"]) and score >= limit
            under, elevated = under + 1 if score < limit else 0, elevated + 1 if up else 0
            thin = r["entity_kind"] in ("ud", "uv", "vd", "uvd") and r["support"] < c["pair_min"]
            if not thin and len(scores) >= c["min_obs"] and rate >= c["min_under_rate"]:
                clean = True
            elif rate < c["revoke"]:
                clean = False
            out.append((*key, r["order_id"], len(scores), len(low), rate, mean, p50, p90, under, elevated, clean))
        self.last.put(events)
        self.flags.update((under, elevated, clean))
        return out


class Cohorts(Ordered):
    out = COHORT_OUT

    def taken(self, key: tuple, rows: list[dict]) -> list[tuple]:
        out, events = [], [tuple(x) for x in self.last.get()] if self.last.exists() else []
        for r in rows:
            events = [*events, (r["t"], r["score"])][-D.BASELINE["cohort_events"] :]
            out.append((*key, r["order_id"], len(events), *marks([s for _, s in events])))
        self.last.put(events)
        return out


class Rolling(Ordered):
    """Orders and refunds of the last 7 and 30 days up to each order, itself left out; rows of one instant count for each other."""

    waits = {"is_refund": "long"}
    out = ROLLING_OUT

    def taken(self, key: tuple, rows: list[dict]) -> list[tuple]:
        out, events = [], [(t, int(r)) for t, r in self.last.get()] if self.last.exists() else []
        events += [(r["t"], r["is_refund"]) for r in rows]
        upto, sums = 0, [0]
        for _, r in events:
            sums.append(sums[-1] + r)
        first, at = {7: 0, 30: 0}, len(events) - len(rows)
        upto = at
        for i, r in enumerate(rows):
            while upto < len(events) and events[upto][0] <= r["t"]:
                upto += 1
            own = []
            for days in (7, 30):
                while events[first[days]][0] < r["t"] - days * DAY:
                    first[days] += 1
                own += [upto - first[days] - 1, sums[upto] - sums[first[days]] - events[at + i][1]]
            out.append((key[0], r["order_id"], *own))
        self.last.put([(t, float(r)) for t, r in events if t >= events[-1][0] - 30 * DAY])
        return out


def _started(rows: DataFrame, keys: list[str], processor: Ordered, path: str, checkpoint: str, delay: str) -> StreamingQuery:
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    out = rows.withWatermark("event_ts", delay).groupBy(*keys).transformWithStateInPandas(processor, processor.out, "append", "eventTime")
    return out.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def baseline_states(observations: DataFrame, path: str, checkpoint: str, delay: str = "1 day") -> StreamingQuery:
    """Settled observations (a row per order and key) -> the baseline of the key after each."""
    return _started(observations, KEY, Baselines(), path, checkpoint, delay)


def cohort_states(observations: DataFrame, path: str, checkpoint: str, delay: str = "1 day") -> StreamingQuery:
    """Settled scores (market, vertical, tenure_bucket, score_head) -> the cohort after each."""
    return _started(observations, COHORT, Cohorts(), path, checkpoint, delay)


def rolling_refund_rate(history: DataFrame, key: str, path: str, checkpoint: str, delay: str = "1 day") -> StreamingQuery:
    """Orders and refunds of an entity in the 7 and 30 days before each of its orders, exact to the instant."""
    rows = history.select(F.col(key).cast("string").alias("entity"), "order_id", "event_ts", F.col("is_refund").cast("long").alias("is_refund"))
    return _started(rows, ["entity"], Rolling(), path, checkpoint, delay)
