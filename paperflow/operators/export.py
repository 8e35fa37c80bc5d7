"""Tabular export (P4, K4, K5): latest completed summaries as 15 string columns."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperflow.functions import dates, text
from paperflow.operators.views import latest_summaries
from paperflow.session import checkpoint_root

ROWS_PER_FILE = 100_000

# Output names (snake_case of the sheet headers), in sheet order.
EXPORT_COLUMNS = (
    "arxiv_id", "original_title", "beginner_title", "intermediate_title", "published_date",
    "authors", "categories", "beginner_overview", "intermediate_overview", "beginner_summary",
    "intermediate_summary", "abstract", "pdf_url", "arxiv_url", "processing_date",
)


def format_export(latest: DataFrame) -> DataFrame:
    """One all-string row per summary. A NULL link exports as '' (D9)."""
    p = lambda c: F.col(f"paper.{c}")
    return latest.select(
        F.coalesce(p("arxiv_id"), F.lit("")).alias("arxiv_id"),
        text.truncate_text(p("title"), text.TITLE_CHARS).alias("original_title"),
        text.truncate_text("beginner_title", text.TITLE_CHARS).alias("beginner_title"),
        text.truncate_text("intermediate_title", text.TITLE_CHARS).alias("intermediate_title"),
        dates.format_or_keep(p("published_date"), dates.EXPORT_DAY_FORMAT).alias("published_date"),
        text.author_label(p("authors")).alias("authors"),
        text.category_label(p("categories_name")).alias("categories"),
        text.truncate_text("beginner_overview", text.OVERVIEW_CHARS).alias("beginner_overview"),
        text.truncate_text("intermediate_overview", text.OVERVIEW_CHARS).alias("intermediate_overview"),
        text.truncate_text("beginner_summary", text.BODY_CHARS).alias("beginner_summary"),
        text.truncate_text("intermediate_summary", text.BODY_CHARS).alias("intermediate_summary"),
        text.truncate_text(p("abstract"), text.BODY_CHARS).alias("abstract"),
        F.coalesce(p("pdf_url"), F.lit("")).alias("pdf_url"),
        F.coalesce(p("abstract_url"), F.lit("")).alias("arxiv_url"),
        dates.format_or_keep("created_at", dates.EXPORT_MINUTE_FORMAT).alias("processing_date"),
    )


def export_latest(summaries: DataFrame, papers: DataFrame, limit: int = 5) -> DataFrame:
    """K5 without the write: J4 -> P4."""
    return format_export(latest_summaries(summaries, papers, limit))


def write_export(rows: DataFrame, path: str, append: bool = False, skip_existing: bool = False) -> int:
    """K4: CSV with a header. Overwrite replaces the folder; append adds files.
    Returns the number of rows written; an empty result writes nothing (K5). The query runs
    once, into a checkpoint; the number of files follows its row count (one for a top-k
    report). Read it back with ``multiLine=True, escape='"'``."""
    if append and skip_existing:
        # Plain append re-adds the same latest rows on every run; this keeps only
        # keys the export does not hold yet (the export is k rows, so reading it is cheap)
        try:
            have = rows.sparkSession.read.option("header", True).option("multiLine", True).option(
                "escape", '"').csv(path).select("arxiv_id")
            rows = rows.join(have, "arxiv_id", "left_anti").select(*EXPORT_COLUMNS)
        except AnalysisException as e:  # no export yet; any other failure is one
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    checkpoint_root(rows.sparkSession)
    rows = rows.checkpoint(eager=True)
    n = rows.count()
    if n == 0:
        return 0
    # Cells keep their newlines; quotes are doubled (RFC 4180) so spreadsheet tools read it.
    (rows.coalesce(-(-n // ROWS_PER_FILE)).write.mode("append" if append else "overwrite")
     .option("header", True).option("escape", '"').csv(path))
    return n


def export_summaries(summaries: DataFrame, papers: DataFrame, path: str, limit: int = 5,
                     append: bool = True, skip_existing: bool = False) -> int:
    """K5: the latest ``limit`` completed summaries, formatted and written to ``path``.
    Returns the number exported; no rows -> 0 and nothing written."""
    return write_export(export_latest(summaries, papers, limit), path, append=append, skip_existing=skip_existing)
