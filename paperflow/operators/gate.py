"""Constraints that act when rows are written (Q1-Q5 at K1 and K3).

Each row gets the reasons for which it may not be stored; good rows go on to the append, the others to a
quarantine table under the batch's own folder, so a repeated batch replaces what it quarantined before. One
pass over the input writes both sides, and the counts are observed by that write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from paperflow.operators import ingest
from paperflow.operators.quality import LENGTH_LIMITS
from paperflow.session import scratch_path

# Columns that the source's tables declare NOT NULL.
REQUIRED_PAPER = ("arxiv_id", "title", "abstract", "authors", "categories", "categories_name", "published_date",
                  "updated_date", "abstract_url")
REQUIRED_SUMMARY = ("arxiv_paper_id", "arxiv_id", "beginner_title", "intermediate_title", "beginner_overview",
                    "intermediate_overview", "beginner_summary", "intermediate_summary")


def row_reasons(columns: list[str], required: tuple[str, ...], limits: dict[str, int]) -> list[Column]:
    """Q2 and Q4 of one row: a reason or null for each rule; a column that is not there counts as null."""
    missing = [F.lit(f"{c} is null") if c not in columns else F.when(F.col(c).isNull(), f"{c} is null") for c in required]
    over = [F.when(F.char_length(c) > n, f"{c} is longer than {n}") for c, n in limits.items() if c in columns]
    return missing + over


def paper_reasons(feed: DataFrame) -> Column:
    """Why a paper may not be stored: Q2, Q4, and Q5 (codes and names that do not align; a paper whose names
    are not filled yet is in order)."""
    named = F.size("categories_name") > 0
    apart = F.when(named & (F.size("categories") != F.size("categories_name")), "codes and names differ in number")
    return F.array_compact(F.array(*row_reasons(feed.columns, REQUIRED_PAPER, LENGTH_LIMITS), apart))


def gate(rows: DataFrame, reasons: Column, quarantine_path: str, batch_id: str) -> tuple[DataFrame, dict]:
    """(good rows, {"kept", "quarantined"}). The others are in ``quarantine_path`` under their batch, with
    ``reasons``. An empty input gives no rows and writes an empty batch."""
    spark = rows.sparkSession
    seen, path = Observation(), scratch_path(spark, "gate")
    ok = F.size("_reasons") == 0
    judged = rows.withColumn("_reasons", reasons).observe(
        seen, F.count_if(ok).alias("kept"), F.count_if(~ok).alias("quarantined")).withColumn("_ok", ok)
    judged.write.partitionBy("_ok").parquet(path)
    back = spark.read.schema(judged.schema).parquet(path)
    bad = back.filter(~F.col("_ok")).drop("_ok").withColumnRenamed("_reasons", "reasons")
    bad.write.mode("overwrite").parquet(f"{quarantine_path}/batch_id={batch_id}")
    return back.filter("_ok").drop("_ok", "_reasons"), seen.get


def gated_append(feed: DataFrame, stored: DataFrame, path: str, quarantine_path: str, batch_id: str,
                 extracted_at=None) -> dict:
    """K1 behind the gate: {"kept", "quarantined", "inserted"}. Copies of a key are not a violation, they
    are resolved by the append (D3)."""
    good, counts = gate(feed, paper_reasons(feed), quarantine_path, batch_id)
    return counts | {"inserted": ingest.append_papers(good, stored, path, extracted_at)}


def gated_summaries(rows: DataFrame, papers: DataFrame, stored: DataFrame, path: str, quarantine_path: str, batch_id: str) -> dict:
    """K3 behind the gate: {"kept", "quarantined"}. Besides Q2 and Q4 a summary needs its paper (Q3) and must be
    the paper's only one (Q1), in the table and in the batch: of several the smallest id is stored."""
    there = papers.select(F.col("id").alias("arxiv_paper_id"), F.lit(True).alias("_paper")).distinct()
    done = stored.select("arxiv_paper_id", F.lit(True).alias("_stored")).distinct()
    first = rows.groupBy("arxiv_paper_id").agg(F.min("id").alias("_first"))
    flagged = rows.join(there, "arxiv_paper_id", "left").join(done, "arxiv_paper_id", "left").join(first, "arxiv_paper_id", "left")
    reasons = F.array_compact(F.array(
        *row_reasons(rows.columns, REQUIRED_SUMMARY, LENGTH_LIMITS),
        F.when(F.col("arxiv_paper_id").isNotNull() & F.col("_paper").isNull(), "no such paper"),
        F.when(F.col("_stored").isNotNull(), "the paper has a summary"),
        F.when(F.col("id") > F.col("_first"), "another summary of the batch comes first")))
    good, counts = gate(flagged, reasons, quarantine_path, batch_id)
    good.select(*stored.columns).write.mode("append").parquet(path)
    return counts
