"""Inverted code table (F7, A1, O10): one row per code of a paper, in folders by code.

Stands in for the index on the categories array. Every append of papers adds its own rows under its batch,
``batch_id=<n>/code=<c>``; a repeated batch replaces them. A search reads only the folders of its codes, and
the counts by code need no paper at all.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from paperflow.functions import dates
from paperflow.operators.search import AI_CATEGORIES

POSTINGS = StructType([StructField("paper_id", LongType()), StructField("published_date", TimestampNTZType()),
                       StructField("copies", LongType())])


def postings_of(papers: DataFrame) -> DataFrame:
    """code, paper_id, published_date, copies: a code that a paper carries twice is one row with two copies.
    Papers without codes, and null codes, have none."""
    each = papers.select(F.explode("categories").alias("code"), F.col("id").alias("paper_id"), "published_date")
    return each.filter("code is not null").groupBy("code", "paper_id", "published_date").agg(F.count(F.lit(1)).alias("copies"))


def append_postings(papers: DataFrame, path: str, batch_id: int) -> None:
    """The postings of the batch's papers; run again it replaces its own. Rows of one code are dealt to as many
    tasks as their number asks for, so a code that most papers carry is written side by side."""
    rows = postings_of(papers).select("paper_id", "published_date", "copies", "code")
    rows.hint("rebalance", "code").write.mode("overwrite").partitionBy("code").parquet(f"{path}/batch_id={batch_id}")


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    whole = StructType([*POSTINGS.fields, StructField("batch_id", LongType()), StructField("code", StringType())])
    spark.createDataFrame([], whole).write.mode("ignore").partitionBy("batch_id", "code").parquet(path)
    return spark.read.schema(whole).parquet(path)


def search_ids(postings: DataFrame, start: dt.datetime, end: dt.datetime, codes=AI_CATEGORIES, offset: int = 0,
               max_results: int | None = None) -> DataFrame:
    """S2 on the inverted table: (id, published_date) of the papers with any of the codes, submitted in
    [start, end] at minute precision, newest first. Only the folders of ``codes`` are read."""
    lo, hi = dates.ntz_lit(start), dates.ntz_lit(end) + F.expr("INTERVAL 1 MINUTE")
    hit = postings.filter(F.col("code").isin(*codes) & (F.col("published_date") >= lo) & (F.col("published_date") < hi))
    ids = hit.select(F.col("paper_id").alias("id"), "published_date").distinct().orderBy(F.desc("published_date"), F.desc("id"))
    ids = ids.offset(offset) if offset else ids
    return ids if max_results is None else ids.limit(max_results)


def search_papers(papers: DataFrame, postings: DataFrame, start: dt.datetime, end: dt.datetime, codes=AI_CATEGORIES,
                  offset: int = 0, max_results: int | None = None) -> DataFrame:
    """The whole rows of ``search_ids``; of a table in day folders only the days of the range are read."""
    ids = search_ids(postings, start, end, codes, offset, max_results).select("id")
    if "published_day" in papers.columns:
        papers = papers.filter(F.col("published_day").between(F.lit(start.date()), F.lit(end.date())))
    return papers.join(ids, "id", "left_semi").orderBy(F.desc("published_date"), F.desc("id"))


def counts_by_code(postings: DataFrame) -> DataFrame:
    """A1 by code: category_id, paper_count (a code that a paper carries twice counts twice), latest_paper."""
    return postings.groupBy(F.col("code").alias("category_id")).agg(
        F.sum("copies").alias("paper_count"), F.max("published_date").alias("latest_paper"))
