"""The request limit (W1) on a stream: keyed state with event-time timers.

Requests may arrive in any order within the watermark's delay. Each caller's state holds the requests that
are not final yet and the times of its last ``cap`` final ones, never more. An event-time timer fires once the
watermark has passed a request; it is then judged, in event order, against the kept times. A second timer
drops the times 60 s after the last request, so a silent caller leaves no state. Requests behind the watermark
are late and get no verdict.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from paperflow.functions.dates import epoch_micros
from paperflow.operators.rates import MAX_PER_MINUTE, WINDOW_MICROS

VERDICT = "event_id long, user_id long, n_window int, throttled boolean"
# Public settings: the state store that keyed state with timers needs.
_STATE = {"spark.sql.streaming.stateStore.providerClass":
          "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
          "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}


def judge(kept: list[int], pending: list[tuple[int, int]], cap: int) -> tuple[list[tuple[int, int]], list[int]]:
    """((event_id, requests in the trailing 60 s, at most cap + 1) per pending (time, event_id) in time order,
    the last ``cap`` times). A request counts itself and those of the same instant."""
    out, kept, k = [], list(kept), 0
    while k < len(pending):
        now, same = pending[k][0], k
        while same < len(pending) and pending[same][0] == now:
            same += 1
        inside = [t for t in kept if now - t < WINDOW_MICROS]
        n = min(cap + 1, len(inside) + same - k)
        out += [(event_id, n) for _, event_id in pending[k:same]]
        kept = (inside + [now] * min(cap, same - k))[-cap:]
        k = same
    return out, kept


class RequestLimiter(StatefulProcessor):
    def __init__(self, cap: int = MAX_PER_MINUTE):
        self.cap = cap

    def init(self, handle) -> None:
        self.handle = handle
        self.kept = handle.getListState("kept", "us long")
        self.pending = handle.getListState("pending", "us long, event_id long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802 - Spark's name
        final = timerValues.getCurrentWatermarkInMs() * 1000
        first = None
        for pdf in rows:
            new = [(int(us), int(e)) for us, e in zip(pdf["us"], pdf["event_id"]) if us >= final]
            if new:
                self.pending.appendList(new)
                first = min(new)[0] if first is None else min(first, min(new)[0])
        if first is not None:
            self.handle.registerTimer(first // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        final = timerValues.getCurrentWatermarkInMs() * 1000
        pending = sorted(self.pending.get()) if self.pending.exists() else []
        ready = [p for p in pending if p[0] < final]
        left = pending[len(ready):]
        kept = [t for (t,) in self.kept.get()] if self.kept.exists() else []
        verdicts, kept = judge(kept, ready, self.cap)
        if ready and left:
            self.pending.put(left)
        elif ready:
            self.pending.clear()
        if left:
            self.handle.registerTimer(left[0][0] // 1000 + 1)
        if kept and not left and kept[-1] + WINDOW_MICROS <= final:
            self.kept.clear()  # no request to come can have them in its window
        elif kept and ready:
            self.kept.put([(t,) for t in kept])
            if not left:
                self.handle.registerTimer((kept[-1] + WINDOW_MICROS) // 1000 + 1)
        if verdicts:
            yield pd.DataFrame({"event_id": [e for e, _ in verdicts], "user_id": key[0],
                                "n_window": [n for _, n in verdicts], "throttled": [n > self.cap for _, n in verdicts]})


def request_verdicts(events: DataFrame, delay: str = "1 minute", cap: int = MAX_PER_MINUTE) -> DataFrame:
    """Streaming DataFrame: a verdict per request (event_id, user_id, ts), as soon as it is final. Requests
    without an id, a caller or a time are left out."""
    keyed = events.filter("event_id is not null and user_id is not null and ts is not null").select(
        "event_id", "user_id", epoch_micros("ts").alias("us"), F.col("ts").cast("timestamp").alias("at"))
    return keyed.withWatermark("at", delay).groupBy("user_id").transformWithStateInPandas(
        RequestLimiter(cap), VERDICT, "Append", "EventTime")


def start_request_limit(events: DataFrame, sink_path: str, checkpoint: str, delay: str = "1 minute",
                        cap: int = MAX_PER_MINUTE, available_now: bool = True):
    """Starts the stream into Parquet at ``sink_path`` and returns the StreamingQuery."""
    conf = events.sparkSession.conf
    before = {k: conf.get(k, None) for k in _STATE}
    for k, v in _STATE.items():
        conf.set(k, v)
    try:
        w = request_verdicts(events, delay, cap).writeStream.outputMode("append").format("parquet").option(
            "path", sink_path).option("checkpointLocation", checkpoint)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
        return w.start()  # the query keeps the settings it was started with
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)
