"""W1 boundary rows, bucketed window equals the plain per-caller window, T3 stream."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from paperflow.operators import rates as RT

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def _events(spark, secs, user=1):
    rows = [(i, T0 + dt.timedelta(seconds=s), user) for i, s in enumerate(secs)]
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long")


def test_fifteen_then_sixteenth_throttled(spark):
    ev = _events(spark, [i * 2 for i in range(16)])          # 16 requests within 30 s
    got = {r["event_id"]: r for r in RT.trailing_rate(ev).collect()}
    assert got[14]["n_window"] == 15 and not got[14]["throttled"]
    assert got[15]["n_window"] == 16 and got[15]["throttled"]
    assert abs(got[15]["wait_s"] - 30.0) < 1e-9             # oldest is 30 s old


def test_exactly_sixty_seconds_old_is_out(spark):
    ev = _events(spark, [0, 60, 60.5])
    got = {r["event_id"]: r["n_window"] for r in RT.trailing_rate(ev).collect()}
    assert got == {0: 1, 1: 1, 2: 2}


def test_bucketed_equals_plain_window(spark, sf):
    from paperflow.sources.tables import read_table
    ev = read_table(spark, sf, "events", "event_id", "user_id", "ts")
    got = RT.trailing_rate(ev).select("event_id", "n_window")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    w = Window.partitionBy("user_id").orderBy(us).rangeBetween(-59_999_999, 0)
    want = ev.select("event_id", F.count(F.lit(1)).over(w).alias("n_window"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_requests_per_minute_stream(spark, sf):
    from paperflow.session import scratch_path
    from paperflow.sources.tables import read_table
    from paperflow.streaming.rates import events_stream, start_requests_per_minute
    src = scratch_path(spark, "t-events")
    ev = read_table(spark, sf, "events", "event_id", "ts", "user_id")
    ev.coalesce(1).write.parquet(src)
    sink, ck = scratch_path(spark, "t-rpm"), scratch_path(spark, "t-rpm-ck")
    start_requests_per_minute(events_stream(spark, src), sink, ck).awaitTermination()
    batch = RT.requests_per_minute(ev)
    streamed = spark.read.parquet(sink)
    # append mode emits closed windows only: all but the newest minute(s), counts exact
    assert streamed.exceptAll(batch).count() == 0
    assert batch.count() - streamed.count() <= 2
    # a late file (events far behind the watermark) changes nothing
    late = spark.createDataFrame([(10**9, dt.datetime(2020, 1, 1), 999_999)], "event_id long, ts timestamp_ntz, user_id long")
    late.write.mode("append").parquet(src)
    start_requests_per_minute(events_stream(spark, src), sink, ck).awaitTermination()
    after = spark.read.parquet(sink)
    assert after.filter(F.col("user_id") == 999_999).count() == 0
    assert after.exceptAll(batch).count() == 0


def test_ties_and_hot_caller_match_plain_window(spark):
    # caller 7 holds a third of all events, many at the very same microsecond
    n = 3000
    ev = spark.range(n).select(
        F.col("id").alias("event_id"),
        (F.lit(T0) + F.make_dt_interval(secs=(F.col("id") % 97) * F.lit(1.5) + F.when(F.col("id") % 5 == 0, 0).otherwise(F.col("id") % 3))).alias("ts"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 11).cast("long").alias("user_id"))
    got = RT.trailing_rate(ev).select("event_id", "n_window", "wait_s")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    w = Window.partitionBy("user_id").orderBy(us).rangeBetween(-59_999_999, 0)
    want = ev.select("event_id", F.count(F.lit(1)).over(w).alias("n_window"), (us - F.min(us).over(w)).alias("age")).select(
        "event_id", "n_window",
        F.when(F.col("n_window") > 15, (F.lit(60_000_000) - F.col("age")) / F.lit(1e6)).otherwise(F.lit(0.0)).alias("wait_s"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_string_caller_key(spark):
    rows = [(i, T0 + dt.timedelta(seconds=i), "caller-a" if i % 2 else "caller-b") for i in range(20)]
    ev = spark.createDataFrame(rows, "req long, ts timestamp_ntz, who string")
    got = {r["req"]: r["n_window"] for r in RT.trailing_rate(ev, key="who", id_col="req").collect()}
    assert got[19] == 10 and got[18] == 10 and got[0] == 1
