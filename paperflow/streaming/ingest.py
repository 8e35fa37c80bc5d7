"""Incremental ingest (T1): new feed files -> P1 -> F12 -> keyed append (K1).

``trigger(availableNow=True)`` processes whatever arrived since the last run and
stops, which is the daily run of the source application; the checkpoint makes the
next run start after the files already read. ``foreachBatch`` is at-least-once, and
a replayed batch is harmless because the append is keyed (existing keys skipped).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperflow.operators import ingest as IN
from paperflow.operators.search import PARTITION_DAY
from paperflow.sources.feed import entries_to_papers, read_feed_stream, rejected_entries, valid_papers

TABLE_COLUMNS = ("id", "arxiv_id", "title", "abstract", "authors", "categories", "categories_name",
                 "published_date", "updated_date", "pdf_url", "abstract_url", "extracted_at")


def _append_batch(spark: SparkSession, table: str, rejects: str | None, taxonomy: DataFrame | None,
                  extracted_at: dt.datetime | None):
    def run(batch: DataFrame, epoch: int) -> None:
        parsed = entries_to_papers(batch, taxonomy, extracted_at).checkpoint(eager=True)
        if rejects:
            # one folder per batch: a repeated batch overwrites its own rejects
            rejected_entries(parsed).write.mode("overwrite").parquet(f"{rejects}/batch_id={epoch}")
        stored = spark.read.parquet(table)
        fresh = IN.assign_ids(IN.dedup_feed(IN.new_rows(valid_papers(parsed), stored)), stored)
        fresh = IN.with_defaults(fresh, extracted_at).withColumn(PARTITION_DAY, F.to_date("published_date"))
        out = fresh.select(*stored.columns).write.mode("append")
        # the layout of the table that is there: files beside day folders would not be read
        (out.partitionBy(PARTITION_DAY) if PARTITION_DAY in stored.columns else out).parquet(table)
    return run


def start_ingest(spark: SparkSession, inbox: str, table: str, checkpoint: str, rejects: str | None = None,
                 taxonomy: DataFrame | None = None, extracted_at: dt.datetime | None = None,
                 available_now: bool = True, max_files: int | None = None):
    """Starts the ingest stream and returns the StreamingQuery. ``table`` must exist."""
    src = read_feed_stream(spark, inbox, max_files)
    w = src.writeStream.foreachBatch(_append_batch(spark, table, rejects, taxonomy, extracted_at)).option(
        "checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
