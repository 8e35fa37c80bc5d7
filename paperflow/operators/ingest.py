"""Idempotent append of feed rows into the papers table.

Steps: drop keys already stored (anti join); de-duplicate the rest per key (D3) with a
partially aggregated ``min_by`` (a key with many copies is combined map-side, never
gathered in one task); give the new rows ids after the current maximum (exact
and dense, see ``numbering``); append, partitioned by published day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from paperflow.functions.dates import epoch_micros, ntz_lit, run_time
from paperflow.operators.numbering import global_row_number

KEY = "arxiv_id"


def dedup_feed(feed: DataFrame) -> DataFrame:
    """D3: one row per key - latest ``updated_date``, then smallest ``abstract_url``."""
    cols = [c for c in feed.columns if c != KEY]
    rank = F.struct(-epoch_micros(F.col("updated_date")), F.col("abstract_url"))
    best = feed.groupBy(KEY).agg(F.min_by(F.struct(*cols), rank).alias("_r"))
    return best.select(KEY, *[F.col(f"_r.{c}").alias(c) for c in cols])


def existing_keys(stored: DataFrame, candidates: DataFrame) -> DataFrame:
    """stored keys that the candidates ask about (semi join, not an IN list)."""
    return stored.select(KEY).join(candidates.select(KEY), KEY, "left_semi")


def new_rows(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """Candidate rows whose key is not stored."""
    return candidates.join(stored.select(KEY), KEY, "left_anti")


def distinct_keys(*frames: DataFrame) -> DataFrame:
    """A4: the set of keys over several inputs."""
    u = frames[0].select(KEY)
    for f in frames[1:]:
        u = u.unionByName(f.select(KEY))
    return u.distinct()


def number_rows(rows: DataFrame, last_id: int, id_col: str = "id") -> DataFrame:
    """Ids behind ``last_id`` in (published_date, key) order. Only these two columns are sorted and
    checkpointed; the wide rows get their number by a join on the key, which is unique in ``rows``."""
    narrow = global_row_number(rows.select("published_date", KEY), [F.col("published_date"), F.col(KEY)])
    numbers = narrow.select(KEY, (F.lit(last_id).cast("long") + F.col("rn")).alias(id_col))
    return rows.drop(id_col).join(numbers, KEY)


def assign_ids(rows: DataFrame, stored: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids continue after the stored maximum, in (published_date, key) order."""
    return number_rows(rows, stored.agg(F.max(id_col)).first()[0] or 0, id_col)


def with_defaults(fresh: DataFrame, extracted_at=None) -> DataFrame:
    """``extracted_at`` and ``created_at`` of inserted rows are one time per run, the
    given one or the time of the call. A feed's own ``extracted_at`` is kept if none is given."""
    now = ntz_lit(extracted_at or run_time())
    own = "extracted_at" in fresh.columns and extracted_at is None
    return fresh.withColumns({"extracted_at": F.coalesce("extracted_at", now) if own else now, "created_at": now})


def ingest(feed: DataFrame, stored: DataFrame, extracted_at=None) -> DataFrame:
    """K1 result: stored rows plus the new ones (U2, by name). ``extracted_at`` /
    ``created_at`` default to one ``as_of`` per run (X26)."""
    fresh = with_defaults(assign_ids(dedup_feed(new_rows(feed, stored)), stored), extracted_at)
    return stored.unionByName(fresh.select(*stored.columns))


def append_papers(feed: DataFrame, stored: DataFrame, path: str, extracted_at=None) -> int:
    """K1 write: append only the new rows, one folder per published day. Returns the count,
    observed by the write itself; the numbering has already fixed the rows in a checkpoint."""
    fresh = with_defaults(assign_ids(dedup_feed(new_rows(feed, stored)), stored), extracted_at)
    seen = Observation()
    fresh = fresh.withColumn("published_day", F.to_date("published_date")).observe(seen, F.count(F.lit(1)).alias("n"))
    fresh.write.mode("append").partitionBy("published_day").parquet(path)
    return seen.get["n"]
