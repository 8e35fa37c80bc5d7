"""Batched append with a ledger (K1, W3): a batch that is run again writes the same ids into its own folder.

Beside the table, whose rows lie under ``batch_id=<n>/published_day=<d>``, stand two small tables: the id range
that a batch has reserved, with its writer, and the batches that are committed. A batch (1) numbers its new
rows, (2) reserves their range behind the last reserved one, (3) writes its folder, (4) commits. Readers see
committed batches only. Run again after a stop at any point it finds its reservation and gives the same ids, so
there is neither a gap nor a copy. While a batch is reserved and not committed, no other one is begun.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from paperflow.operators import ingest
from paperflow.operators.search import PARTITION_DAY
from paperflow.schemas import PAPERS
from paperflow.session import checkpoint_root

RESERVED = StructType([StructField("writer", StringType()), StructField("first_id", LongType()), StructField("n_rows", LongType())])
COMMITTED = StructType([StructField("n_rows", LongType())])


class BatchConflict(RuntimeError):
    """Another batch or writer is not finished."""


def _ledger(spark: SparkSession, root: str, kind: str, schema: StructType) -> DataFrame:
    path = f"{root}/{kind}"
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    whole = StructType(schema.fields + [StructField("batch_id", LongType())])
    return spark.read.schema(whole).parquet(path).filter("batch_id is not null")


def reserved(spark: SparkSession, root: str) -> DataFrame:
    """batch_id, writer, first_id, n_rows: one row per batch ever begun."""
    return _ledger(spark, root, "reserved", RESERVED)


def committed(spark: SparkSession, root: str) -> DataFrame:
    """batch_id, n_rows of the finished batches."""
    return _ledger(spark, root, "committed", COMMITTED)


def read_papers(spark: SparkSession, root: str) -> DataFrame:
    """The papers of the committed batches, with ``batch_id`` and the day folder."""
    whole = StructType([*PAPERS.fields]).add("batch_id", LongType()).add(PARTITION_DAY, "date")
    spark.createDataFrame([], whole).write.mode("ignore").partitionBy("batch_id", PARTITION_DAY).parquet(f"{root}/papers")
    rows = spark.read.schema(whole).parquet(f"{root}/papers")
    return rows.join(committed(spark, root).select("batch_id"), "batch_id", "left_semi")


def reserve(spark: SparkSession, root: str, batch_id: int, writer: str, n_rows: int) -> int:
    """First id of the batch. A batch that has its range keeps it; a new one gets the next.

    Raises ``BatchConflict`` if the batch belongs to another writer, or another batch is not committed.
    """
    ranges = reserved(spark, root)
    own = ranges.filter(F.col("batch_id") == batch_id).first()
    if own is not None:
        if own["writer"] != writer:
            raise BatchConflict(f"batch {batch_id} belongs to {own['writer']}")
        if own["n_rows"] != n_rows:
            raise BatchConflict(f"batch {batch_id} had {own['n_rows']} rows, now {n_rows}")
        return own["first_id"]
    open_batch = ranges.join(committed(spark, root), "batch_id", "left_anti").first()
    if open_batch is not None:
        raise BatchConflict(f"batch {open_batch['batch_id']} of {open_batch['writer']} is not finished")
    last = ranges.agg(F.max(F.col("first_id") + F.col("n_rows"))).first()[0]
    first_id = 1 if last is None else last
    # errorifexists: of two writers that got here, the one that is late fails.
    spark.createDataFrame([(writer, first_id, n_rows)], RESERVED).coalesce(1).write.mode("errorifexists").parquet(
        f"{root}/reserved/batch_id={batch_id}")
    return first_id


def append_batch(feed: DataFrame, root: str, batch_id: int, writer: str, extracted_at=None, commit: bool = True) -> dict:
    """K1 as batch ``batch_id``: {"inserted", "first_id"}. Keys of committed papers are skipped, copies inside
    the feed resolved (D3), ids dense in (published_date, key) order. A committed batch is not run again.
    Without ``commit`` the batch is written and its rows are not visible until it is run again."""
    spark = feed.sparkSession
    checkpoint_root(spark)
    done = committed(spark, root).filter(F.col("batch_id") == batch_id).first()
    if done is not None:
        return {"inserted": 0, "first_id": reserved(spark, root).filter(F.col("batch_id") == batch_id).first()["first_id"]}
    stored = read_papers(spark, root)
    fresh = ingest.dedup_feed(ingest.new_rows(feed, stored)).checkpoint(eager=True)
    n_rows = fresh.count()
    first_id = reserve(spark, root, batch_id, writer, n_rows)
    numbered = ingest.number_rows(fresh, first_id - 1)
    whole = ingest.with_defaults(numbered, extracted_at).withColumn(PARTITION_DAY, F.to_date("published_date"))
    whole.select(*PAPERS.fieldNames(), PARTITION_DAY).write.mode("overwrite").partitionBy(PARTITION_DAY).parquet(
        f"{root}/papers/batch_id={batch_id}")
    if commit:
        spark.createDataFrame([(n_rows,)], COMMITTED).coalesce(1).write.mode("overwrite").parquet(f"{root}/committed/batch_id={batch_id}")
    return {"inserted": n_rows, "first_id": first_id}
