"""The daily run as one call (the source application's main entry point), composed
from the jobs in this package: weekday-aware target day (F2) -> feed scan (S1) ->
entry -> paper with rejects (P1, F12) -> day filter (F1) -> keyed append (K1) ->
name backfill in place (J6/K2) -> optionally one summary batch (T2/M2).

Returns separate counters (A5, D20) instead of one summed total. Each is observed by the pass that
does the work (``DataFrame.observe``), so no stage is counted a second time; with ``history_path`` a run
also leaves a row of them, under its run day and mode.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from paperflow.functions import dates
from paperflow.operators import catalog, ingest
from paperflow.session import checkpoint_root
from paperflow.sources import feed as FD

COUNTERS = ("kept", "filtered_out", "rejected", "inserted", "names_filled", "summarized")


def target_day_of(as_of: dt.date) -> dt.date:
    """F2 for a run parameter: Monday looks back to Friday, any other day one day."""
    return as_of - dt.timedelta(days=3 if as_of.weekday() == 0 else 1)


def daily_run(spark: SparkSession, feed_path: str, papers_path: str, taxonomy: DataFrame, as_of: dt.date,
              summaries_path: str | None = None, pages: DataFrame | None = None,
              model_fn: Callable[[str, int], str] | None = None, model_name: str = "model",
              summarize_limit: int | None = None, rejects_path: str | None = None,
              day: dt.date | str | None = None, days_back: int | None = None, history_path: str | None = None) -> dict:
    """``papers_path`` is a parquet table partitioned by ``published_day``. ``as_of`` is
    the run date. Modes: default = its target day (F2); ``day`` = one given day (F3,
    ``YYYY-MM-DD`` text is validated); ``days_back`` = every day from as_of - 1 - N
    through as_of - 1 (F4, the range the request asks for, D1). ``summarize_limit`` papers
    are summarized, newest first; None (the default) means the whole queue, in one pass. A run that
    is repeated replaces its own rejects and its own row of the history."""
    if day is not None:
        first = last = dates.parse_day(day) if isinstance(day, str) else day
    elif days_back is not None:
        last = as_of - dt.timedelta(days=1)
        first = last - dt.timedelta(days=days_back)
    else:
        first = last = target_day_of(as_of)
    on = dates.in_day_range("published_date", first, last)
    seen = Observation()
    parsed = FD.entries_to_papers(FD.read_feed(spark, feed_path), taxonomy,
                                  extracted_at=dt.datetime.combine(as_of, dt.time()))
    checkpoint_root(spark)
    # the pass that reads the feed counts what it finds
    parsed = parsed.observe(seen, F.count_if(F.col("is_valid") & on).alias("kept"), F.count_if(F.col("is_valid") & ~on).alias("filtered_out"),
                            F.count_if(~F.col("is_valid")).alias("rejected")).checkpoint(eager=True)
    run = f"run_day={as_of}/days={first}_{last}"
    if rejects_path:
        FD.rejected_entries(parsed).write.mode("overwrite").parquet(f"{rejects_path}/{run}")
    valid = FD.valid_papers(parsed)
    stored = spark.read.parquet(papers_path).drop("published_day")
    inserted = ingest.append_papers(valid.filter(on), stored, papers_path,
                                    extracted_at=dt.datetime.combine(as_of, dt.time()))
    filled = catalog.backfill_names_in_place(spark, papers_path, taxonomy)
    summarized = 0
    if model_fn is not None and summaries_path is not None:
        from paperflow.streaming.drain import drain, drain_loop
        papers = spark.read.parquet(papers_path).drop("published_day")
        if summarize_limit is None:
            summaries = spark.read.parquet(summaries_path)
            rows, _ = drain(papers, summaries, pages, model_fn, model_name)
            seen_rows = Observation()
            (rows.select(*summaries.columns).observe(seen_rows, F.count(F.lit(1)).alias("n"))
             .write.mode("append").parquet(summaries_path))
            summarized = seen_rows.get["n"]
        else:
            summarized = drain_loop(spark, papers, summaries_path, pages, model_fn, model_name,
                                    batch_size=summarize_limit, single_batch=True)["processed"]
    counters = {**seen.get, "inserted": inserted, "names_filled": filled, "summarized": summarized}
    if history_path:
        spark.createDataFrame([tuple(counters[c] for c in COUNTERS)], ", ".join(f"{c} long" for c in COUNTERS)).coalesce(
            1).write.mode("overwrite").parquet(f"{history_path}/{run}")
    return {"first_day": first.isoformat(), "last_day": last.isoformat(), **counters}
