"""Feed search and day selection over a papers table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperflow.functions import dates

# Fixed values of the source application: the categories it searches.
AI_CATEGORIES = ("cs.AI", "cs.LG", "cs.CV", "cs.CL", "cs.NE", "stat.ML", "cs.RO", "cs.IR")

# Keyword list declared by the source application (never used there).
AI_KEYWORDS = (
    "neural network", "deep learning", "machine learning", "artificial intelligence",
    "natural language processing", "computer vision", "reinforcement learning",
    "transformer", "attention mechanism", "generative model", "large language model",
    "llm", "gpt", "bert", "diffusion model", "gan", "autoencoder",
)


def in_categories(codes=AI_CATEGORIES):
    """any of the codes is among the paper's categories."""
    return F.arrays_overlap(F.col("categories"), F.array(*[F.lit(c) for c in codes]))


def search_papers(papers: DataFrame, start: dt.datetime, end: dt.datetime, codes=AI_CATEGORIES,
                  offset: int = 0, max_results: int | None = None) -> DataFrame:
    """Category filter AND submitted time in [start, end] at minute precision,
    newest first. ``offset`` and ``max_results`` cut a page out of it, chosen on narrow
    columns; without them every hit is returned."""
    lo = dates.ntz_lit(start)
    hi = dates.ntz_lit(end) + F.expr("INTERVAL 1 MINUTE")
    hit = papers.filter(in_categories(codes) & (F.col("published_date") >= lo) & (F.col("published_date") < hi))
    order = [F.col("published_date").desc(), F.col("id").desc()]
    if not offset and max_results is None:
        return hit.orderBy(*order)
    keys = hit.select("id", "published_date").orderBy(*order).offset(offset)
    keys = keys if max_results is None else keys.limit(max_results)
    return hit.join(keys.select("id"), "id", "left_semi").orderBy(*order)


PARTITION_DAY = "published_day"


def _prune(papers: DataFrame, first, last) -> DataFrame:
    """On a stored table partitioned by day, also filter the partition column so the
    scan lists only the matching folders (partition pruning); row filters still apply."""
    if PARTITION_DAY in papers.columns:
        return papers.filter(F.col(PARTITION_DAY).between(first, last))
    return papers


def papers_on_day(papers: DataFrame, day: dt.date | str) -> DataFrame:
    """papers published on ``day`` (UTC); a string must be ``YYYY-MM-DD``."""
    d = dates.parse_day(day) if isinstance(day, str) else day
    return _prune(papers, F.lit(d), F.lit(d)).filter(dates.on_day("published_date", d))


def papers_in_range(papers: DataFrame, as_of: dt.date, days_back: int) -> DataFrame:
    """the intended range backfill (D1): every day from end - N through end = as_of - 1."""
    first, last = dates.backfill_range(as_of, days_back)
    return _prune(papers, first, last).filter(dates.in_day_range("published_date", first, last))


def keyword_hits(papers: DataFrame, keywords=AI_KEYWORDS) -> DataFrame:
    """how many keywords occur (substring match) in lower(title + ' ' + abstract).

    One ``contains`` per keyword instead of a lambda over an array: lambdas run
    interpreted and would lower-case the text once per keyword, while here the
    lowered text is a common subexpression computed once inside codegen."""
    body = F.lower(F.concat_ws(" ", "title", "abstract"))
    n = sum((F.contains(body, F.lit(k)).cast("bigint") for k in keywords), F.lit(0).cast("bigint"))
    return papers.select("id", n.alias("n_keywords"), (n > 0).alias("is_ai"))
