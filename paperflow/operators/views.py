"""The stored views of the source application as DataFrame functions.

Sorting is applied only where the result is a report (top-k); view bodies stay
unordered so Catalyst can drop the sort under joins and aggregates.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperflow.functions.dates import ntz_lit

QUEUE_COLUMNS = ("id", "arxiv_id", "title", "abstract", "pdf_url", "published_date")

def newest_first(df: DataFrame, ts: str = "published_date", key: str = "id") -> DataFrame:
    """L1 with the id tie-breaker."""
    return df.orderBy(F.col(ts).desc(), F.col(key).desc())


def top_k(narrow: DataFrame, wide: DataFrame, key: str, order: list, k: int) -> DataFrame:
    """Top-k of ``wide`` chosen on ``narrow`` (key + sort columns only), then widened.

    ``orderBy().limit()`` on a wide table ships every partition's k wide rows to one
    task; choosing the k keys on the narrow columns first means only keys travel, and
    only k wide rows are ever fetched (semi join against a k-row table)."""
    keys = narrow.orderBy(*order).limit(k).select(key)
    return wide.join(keys, key, "left_semi").orderBy(*order).limit(k)


def papers_with_summaries(papers: DataFrame, summaries: DataFrame) -> DataFrame:
    """Every paper with its summary columns, NULL when not summarized."""
    p = papers.select(
        F.col("id").alias("paper_id"), "arxiv_id", F.col("title").alias("original_title"), "abstract",
        "authors", "categories", "categories_name", "published_date", "pdf_url",
    )
    s = summaries.select(
        F.col("arxiv_paper_id").alias("paper_id"), "beginner_title", "intermediate_title",
        "beginner_overview", "intermediate_overview", "beginner_summary", "intermediate_summary",
        "processing_status", "model_name", F.col("created_at").alias("summary_created_at"),
    )
    return p.join(s, "paper_id", "left")


def papers_needing_summaries(papers: DataFrame, summaries: DataFrame, requeue_errors: bool = False) -> DataFrame:
    """Papers with a PDF link and no summary row. Written as an anti join
    (Spark keeps LEFT JOIN + IS NULL as an outer join plus filter). Any summary row,
    an ``error`` row included, takes a paper off the queue (D21) unless
    ``requeue_errors`` is set."""
    linked = papers.filter(F.col("pdf_url").isNotNull()).select(*[c for c in QUEUE_COLUMNS if c in papers.columns])
    if requeue_errors:
        summaries = summaries.filter(F.coalesce(F.col("processing_status"), F.lit("")) != "error")
    done = summaries.select(F.col("arxiv_paper_id").alias("id"))
    return linked.join(done, "id", "left_anti")


def queue_head(papers: DataFrame, summaries: DataFrame, limit: int) -> DataFrame:
    """L3: the first ``limit`` papers of the queue, newest first."""
    order = [F.col("published_date").desc(), F.col("id").desc()]
    narrow = papers_needing_summaries(papers.select("id", "pdf_url", "published_date"), summaries)
    wide = papers.select(*QUEUE_COLUMNS)
    return top_k(narrow.select("id", "published_date"), wide, "id", order, limit)


def queue_depth(papers: DataFrame, summaries: DataFrame) -> DataFrame:
    """A3: exact size of the queue, one row."""
    return papers_needing_summaries(papers, summaries).agg(F.count(F.lit(1)).alias("remaining"))


def latest_summaries(summaries: DataFrame, papers: DataFrame, limit: int) -> DataFrame:
    """Completed summaries with their paper embedded as a struct, newest k."""
    order = [F.col("created_at").desc(), F.col("id").desc()]
    done = summaries.filter(F.col("processing_status") == "completed")
    # narrow pass: keys of completed summaries whose paper exists (the inner join)
    narrow = done.select("id", "arxiv_paper_id", "created_at").join(
        papers.select(F.col("id").alias("arxiv_paper_id")), "arxiv_paper_id", "left_semi")
    p = papers.select(
        F.col("id").alias("arxiv_paper_id"),
        F.struct("arxiv_id", "title", "authors", "categories_name", "published_date",
                 "abstract", "pdf_url", "abstract_url").alias("paper"),
    )
    top = top_k(narrow, done, "id", order, limit)
    p = p.join(top.select("arxiv_paper_id"), "arxiv_paper_id", "left_semi")
    return top.join(p, "arxiv_paper_id", "inner").orderBy(*order).limit(limit)


def recent_papers(papers: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    """published within ``days`` of ``as_of`` (inclusive lower bound)."""
    lo = ntz_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    if "published_day" in papers.columns:   # stored table: prune day folders too
        papers = papers.filter(F.col("published_day") >= F.to_date(lo))
    return papers.filter(F.col("published_date") >= lo)


def papers_by_category(papers: DataFrame, ordered: bool = False) -> DataFrame:
    """A1: names and codes unnested in parallel (shorter side padded with NULL), grouped
    by both. Partial aggregation runs map-side, so a hot category is combined before
    the shuffle."""
    z = papers.select(
        F.inline(F.arrays_zip(F.col("categories_name").alias("n"), F.col("categories").alias("c"))),
        "published_date",
    )
    out = (z.groupBy(F.col("n").alias("category_name"), F.col("c").alias("category_id"))
           .agg(F.count(F.lit(1)).alias("paper_count"), F.max("published_date").alias("latest_paper")))
    # L4: largest first (names as tie-breakers) when the result is read as a report
    return out.orderBy(F.desc("paper_count"), "category_name", "category_id") if ordered else out


def papers_by_category_name(papers: DataFrame, ordered: bool = False) -> DataFrame:
    """A2: the same by name only; papers with no names contribute nothing."""
    z = papers.select(F.explode("categories_name").alias("category_name"), "published_date")
    out = z.groupBy("category_name").agg(
        F.count(F.lit(1)).alias("paper_count"), F.max("published_date").alias("latest_paper"))
    return out.orderBy(F.desc("paper_count"), "category_name") if ordered else out
