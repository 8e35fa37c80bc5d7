"""T3 with the open minute: the merged table equals the batch counts, late rows correct it, a replay changes nothing."""

import datetime as dt

from paperflow.operators.rates import requests_per_minute
from paperflow.session import scratch_path
from paperflow.streaming import rates as R

T = dt.datetime(2024, 1, 1, 23, 58)
SCHEMA = "event_id long, ts timestamp_ntz, user_id long"


def rows(df):
    return sorted((r["window_start"], -1 if r["user_id"] is None else r["user_id"], r["n_requests"]) for r in df.collect())


def test_open_minutes_late_rows_and_replays(spark):
    src, table, ck = (scratch_path(spark, f"t-live-{x}") for x in ("in", "table", "ck"))
    first = [(k, T + dt.timedelta(seconds=7 * k), k % 3) for k in range(40)] + [(100, T, None), (101, T, None)]
    late = [(200 + k, T + dt.timedelta(seconds=11 * k), k % 4) for k in range(10)]  # inside the watermark
    lost = [(300, T - dt.timedelta(hours=9), 1)]  # behind it
    spark.createDataFrame(first, SCHEMA).coalesce(1).write.parquet(src)
    R.start_live_requests_per_minute(R.events_stream(spark, src), table, ck, watermark="1 hour").awaitTermination()
    assert rows(spark.read.parquet(table)) == rows(requests_per_minute(spark.createDataFrame(first, SCHEMA)))
    untouched = {r[0] for r in spark.read.parquet(table).filter("window_day = date'2024-01-02'").selectExpr("_metadata.file_path").collect()}
    spark.createDataFrame(late[:3] + lost, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    R.start_live_requests_per_minute(R.events_stream(spark, src), table, ck, watermark="1 hour").awaitTermination()
    want = rows(requests_per_minute(spark.createDataFrame(first + late[:3], SCHEMA)))
    assert rows(spark.read.parquet(table)) == want
    # only the touched day was rewritten
    assert untouched == {r[0] for r in spark.read.parquet(table).filter("window_day = date'2024-01-02'").selectExpr("_metadata.file_path").collect()}
    replay = requests_per_minute(spark.createDataFrame(first + late[:3], SCHEMA)).filter("user_id < 2")
    R.merge_counts(table)(replay, 7)
    assert rows(spark.read.parquet(table)) == want
    R.merge_counts(table)(replay.limit(0), 8)
    assert rows(spark.read.parquet(table)) == want
