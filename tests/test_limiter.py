"""W1 on a stream against the batch operator, with late and shuffled requests and a hot caller."""

import datetime as dt
import random

from paperflow.operators.rates import trailing_rate
from paperflow.session import scratch_path
from paperflow.streaming import limiter as L
from paperflow.streaming.rates import events_stream

RNG = random.Random(3)
START = dt.datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp_ntz, user_id long"


def requests():
    at = [(u, START + dt.timedelta(seconds=RNG.random() * 600)) for u in range(5) for _ in range(40)]
    at += [(9, START + dt.timedelta(seconds=k // 4)) for k in range(1200)]  # a hot caller, four at a time
    return [(k, t, u) for k, (u, t) in enumerate(at)]


def deliver(spark, path, rows, files):
    """``files`` deliveries in the order of the rows' time, but rows up to 30 s early or late."""
    shuffled = sorted(rows, key=lambda r: r[1] + dt.timedelta(seconds=RNG.random() * 30))
    size = -(-len(rows) // files)
    for k in range(0, len(rows), size):
        spark.createDataFrame(shuffled[k:k + size], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_verdicts_equal_the_batch_and_the_state_stays_small(spark):
    rows = requests()
    src, sink, ck = (scratch_path(spark, f"t-limit-{x}") for x in ("in", "out", "ck"))
    deliver(spark, src, rows, 3)
    closing = START + dt.timedelta(hours=1)
    spark.createDataFrame([(-1, closing, -1), (-2, START, 0), (None, START, 1), (-3, closing, None)], SCHEMA).coalesce(1).write.mode(
        "append").parquet(src)  # -2 is late: far behind the watermark of this batch
    query = L.start_request_limit(events_stream(spark, src, max_files=1), sink, ck, delay="40 seconds")
    query.awaitTermination()
    got = {r["event_id"]: (r["user_id"], r["n_window"], r["throttled"]) for r in spark.read.parquet(sink).collect()}
    batch = trailing_rate(spark.createDataFrame(rows, SCHEMA)).collect()
    assert got == {r["event_id"]: (r["user_id"], min(16, r["n_window"]), r["throttled"]) for r in batch}
    assert sum(t for _, _, t in got.values()) > 1000
    # At the end every caller but the closing one has dropped its state.
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 6
    # a second start finds nothing new
    L.start_request_limit(events_stream(spark, src, max_files=1), sink, ck, delay="40 seconds").awaitTermination()
    assert spark.read.parquet(sink).count() == len(rows)


def test_judge_keeps_at_most_the_cap():
    pending = [(k // 50, k) for k in range(5000)]  # fifty requests in each microsecond
    out, kept = L.judge([], pending, 15)
    assert len(kept) == 15 and [n for _, n in out] == [16] * 5000
    out, kept = L.judge([0, 10], [(60_000_000, 7), (60_000_010, 8)], 15)
    assert out == [(7, 2), (8, 2)] and kept == [60_000_000, 60_000_010]
    assert L.judge([], [], 15) == ([], [])
