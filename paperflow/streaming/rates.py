"""Per-minute request counts as a stream (T3): late rows past the watermark are
dropped; each minute is emitted once it closes (append mode), or kept up to date in a
table while it is open (update mode with a merging sink)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperflow.operators.rates import requests_per_minute
from paperflow.session import checkpoint_root


def events_stream(spark: SparkSession, path: str, schema: str = "event_id long, ts timestamp_ntz, user_id long",
                  max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format("parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def start_requests_per_minute(events: DataFrame, sink_path: str, checkpoint: str, watermark: str = "1 minute",
                              available_now: bool = True):
    counts = requests_per_minute(events, watermark=watermark)
    w = (counts.writeStream.outputMode("append").format("parquet").option("path", sink_path)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def merge_counts(path: str, day: str = "window_day"):
    """``foreachBatch`` sink: the batch's counts replace the stored ones of the same minute and caller; only the
    day folders they touch are rewritten. Counts are totals, so a repeated batch changes nothing."""
    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        new = batch.withColumn(day, F.to_date("window_start")).checkpoint(eager=True)
        if new.isEmpty():
            return
        stored = spark.read.schema(new.schema).parquet(path)
        days = new.select(day).distinct()
        same = stored["window_start"].eqNullSafe(new["window_start"]) & stored["user_id"].eqNullSafe(new["user_id"])
        kept = stored.join(days, day, "left_semi").join(new, same, "left_anti")
        merged = kept.unionByName(new).checkpoint(eager=True)  # the rewrite must not read the files it replaces
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    return run


def start_live_requests_per_minute(events: DataFrame, table: str, checkpoint: str, watermark: str = "1 minute",
                                   available_now: bool = True):
    """T3 with the open minute: every batch brings the counts of the minutes it touched up to date in ``table``
    (day folders), so the newest minute is there and rows late by less than the watermark correct their
    minute. Callers without an id count as one; later rows are dropped."""
    spark = events.sparkSession
    checkpoint_root(spark)
    counts = requests_per_minute(events, watermark=watermark)
    spark.createDataFrame([], counts.schema).withColumn("window_day", F.to_date("window_start")).write.mode("ignore").partitionBy(
        "window_day").parquet(table)
    w = counts.writeStream.outputMode("update").foreachBatch(merge_counts(table)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
