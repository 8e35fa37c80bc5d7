"""Request-rate views (W1, A8, T3 batch form) and run counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from paperflow.functions.dates import epoch_micros
from paperflow.operators import taxonomy
from paperflow.session import checkpoint_root

# Fixed values of the source application's limiter.
MAX_PER_MINUTE = 15
WINDOW_MICROS = 60_000_000


def _prefix_events(batches):
    """Per partition (rows arrive sorted): events (kind 1) strictly before each row."""
    seen = 0
    for pdf in batches:
        is_event = (pdf["_kind"] == 1).to_numpy().astype("int64")
        before = is_event.cumsum() - is_event + seen
        seen += int(is_event.sum())
        yield pdf.assign(_before=before)


def trailing_rate(events: DataFrame, key: str = "user_id", ts: str = "ts", cap: int = MAX_PER_MINUTE,
                  id_col: str = "event_id") -> DataFrame:
    """Per caller and request, requests in the trailing 60 s (age < 60 s, the request
    itself and same-instant requests included), whether the cap was hit, and the wait
    the limiter would impose (60 s minus the age of the oldest request in the window).

    Rank differences instead of a window function, so no caller or instant is ever
    gathered into one task: every event emits a probe at t - 59.999999 s (sorted
    before events at equal time) and one at t (sorted after them). After one global
    sort (range partitioning, checkpointed) the number of events before each probe is
    a per-partition prefix count plus the event counts of earlier partitions (a table
    with one row per partition). n_window = before(upper probe) - before(lower probe):
    other callers' events cancel out. The oldest event in the window is the one whose
    global event rank is before(lower probe) + 1, found with an equi-join.
    """
    spark = events.sparkSession
    checkpoint_root(spark)
    us = epoch_micros(F.col(ts))
    # Rows, not ids, are the requests: ids may repeat. The checkpoint fixes the row numbers.
    events = events.select(id_col, key, ts, F.monotonically_increasing_id().alias("_ref")).checkpoint(eager=True)
    base = events.select("_ref", F.col(key).alias("_key"), us.alias("_us"))
    rows = base.select("_ref", "_key", F.inline(F.array(
        F.struct((F.col("_us") - (WINDOW_MICROS - 1)).alias("_t"), F.lit(0).alias("_kind")),
        F.struct(F.col("_us").alias("_t"), F.lit(1).alias("_kind")),
        F.struct(F.col("_us").alias("_t"), F.lit(2).alias("_kind")))))
    order = ["_key", "_t", "_kind", "_ref"]
    fixed = rows.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint(eager=True)
    tagged = fixed.withColumn("_pid", F.spark_partition_id())
    schema = StructType(tagged.schema.fields + [StructField("_before", LongType(), False)])
    local = tagged.mapInPandas(_prefix_events, schema)
    local = local.checkpoint(eager=True)
    counts = local.groupBy("_pid").agg(F.count_if(F.col("_kind") == 1).alias("_n"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    g = local.join(F.broadcast(offsets), "_pid").select(
        "_ref", "_key", "_t", "_kind", (F.col("_off") + F.col("_before")).alias("_g"))
    lo = g.filter(F.col("_kind") == 0).select("_ref", F.col("_g").alias("_glo"))
    hi = g.filter(F.col("_kind") == 2).select("_ref", F.col("_g").alias("_ghi"))
    ranked = g.filter(F.col("_kind") == 1).select((F.col("_g") + 1).alias("_rank"), F.col("_t").alias("_oldest"))
    span = lo.join(hi, "_ref").join(ranked, F.col("_glo") + 1 == F.col("_rank"))
    per_event = span.select("_ref", (F.col("_ghi") - F.col("_glo")).alias("n_window"),
                            "_oldest")
    out = events.join(per_event, "_ref")
    age = us - F.col("_oldest")
    throttled = F.col("n_window") > cap
    return out.select(
        id_col, key, ts, "n_window", throttled.alias("throttled"),
        F.when(throttled, (F.lit(WINDOW_MICROS) - age) / F.lit(1e6)).otherwise(F.lit(0.0)).alias("wait_s"),
    )


def requests_per_minute(events: DataFrame, key: str = "user_id", ts: str = "ts",
                        watermark: str | None = None) -> DataFrame:
    """Per-minute request counts per caller. With ``watermark`` (streaming) late rows
    are dropped and a window is emitted once it closes. ``timestamp_ntz`` is cast first
    because watermarks need a zoned timestamp."""
    e = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    if watermark:
        e = e.withWatermark("_ts", watermark)
    g = e.groupBy(F.window("_ts", "1 minute"), key).agg(F.count(F.lit(1)).alias("n_requests"))
    return g.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), key, "n_requests")


def success_rate(attempts: DataFrame, by: list[str], ok: str = "ok") -> DataFrame:
    """Attempted, completed, failed and completed/attempted x 100 rounded half-up to
    one decimal (exact integer arithmetic, so every engine agrees); no attempts -> NULL."""
    g = attempts.groupBy(*by).agg(F.count(F.lit(1)).alias("attempted"), F.count_if(F.col(ok)).alias("completed"))
    rate = F.expr("CAST((2000 * completed + attempted) div (2 * attempted) AS DOUBLE) / 10")
    return g.select(*by, "attempted", "completed", (F.col("attempted") - F.col("completed")).alias("failed"),
                    F.when(F.col("attempted") > 0, rate).alias("success_rate"))


def run_counts(feed: DataFrame, stored: DataFrame, summaries: DataFrame, on_day, done_on) -> DataFrame:
    """A5 over tables: (metric, value) of a run - entries kept and filtered out by ``on_day``, kept ones not yet
    stored, stored rows to name, and summaries completed where ``done_on`` holds. ``feed`` has unique keys and
    is read once; every count is zero for empty tables."""
    known = stored.select("arxiv_id", F.lit(True).alias("_stored"))
    on = F.coalesce(on_day, F.lit(False))
    parts = [
        feed.join(known, "arxiv_id", "left").agg(
            F.count_if(on).alias("kept"), F.count_if(~on).alias("filtered_out"),
            F.count_if(on & F.col("_stored").isNull()).alias("inserted")),
        taxonomy.needs_names(stored).agg(F.count_if(F.size("categories") > 0).alias("names_filled")),
        summaries.agg(F.count_if(done_on & (F.col("processing_status") == "completed")).alias("summarized"))]
    long = [p.unpivot([], p.columns, "metric", "value") for p in parts]
    return long[0].unionByName(long[1]).unionByName(long[2])
