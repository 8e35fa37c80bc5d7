"""Page-text assembly (A7, X18): the text the model sees for one paper."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperflow.functions.text import clean_text


def assemble_pages(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Per document: its pages in order, each cleaned, empty ones skipped, joined by
    newline and cleaned again; no text -> NULL. ``max_pages`` (the source application
    reads 10) keeps the first pages only, before the shuffle.
    """
    pages = pages if max_pages is None else pages.filter(F.col("page") < max_pages)
    p = pages.select("doc_id", "page", clean_text("text").alias("t"))
    g = p.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("page", "t"))).alias("pp"))
    kept = F.transform(F.filter("pp", lambda x: x["t"] != ""), lambda x: x["t"])
    joined = clean_text(F.array_join(kept, "\n"))
    return g.select("doc_id", F.nullif(joined, F.lit("")).alias("text"))
