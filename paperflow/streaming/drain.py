"""Queue drain (T2, M2): summarize every queued paper, append the rows, report what
is left.

The source application loops over batches of 15 papers per minute until a batch
yields nothing. Here the whole queue is one distributed pass - every paper gets
its attempts in parallel, and pacing is configuration (``calls_per_minute``)
- while ``single_batch`` keeps the one-batch mode. The batch number of each paper
(W2) is kept on the result so the pacing order stays visible.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperflow.functions.text import model_input
from paperflow.operators import inference, ledger, views
from paperflow.operators.numbering import batch_numbers
from paperflow.operators.pages import assemble_pages
from paperflow.session import scratch_path


def queue_prompts(papers: DataFrame, summaries: DataFrame, pages: DataFrame | None,
                  batch_size: int, single_batch: bool) -> DataFrame:
    """M2 input: queued papers (id, prompt); abstract only when there is no page text."""
    if single_batch:
        q = views.queue_head(papers, summaries, batch_size)
    else:
        q = views.papers_needing_summaries(papers, summaries)
    if pages is not None:
        # only pages of queued papers are cleaned and assembled
        wanted = pages.join(q.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
        q = q.join(assemble_pages(wanted).withColumnRenamed("doc_id", "id"), "id", "left")
    else:
        q = q.withColumn("text", F.lit(None).cast("string"))
    return q.select("id", model_input("title", "abstract", "text").alias("prompt"))


def queue_batches(papers: DataFrame, summaries: DataFrame, batch_size: int) -> DataFrame:
    """W2 over the queue, numbered on narrow columns only: (id, batch_no)."""
    narrow = views.papers_needing_summaries(papers.select("id", "pdf_url", "published_date"), summaries)
    b = batch_numbers(narrow.select("id", "published_date"), [F.col("published_date").desc(), F.col("id").desc()],
                      batch_size)
    return b.select("id", "batch_no")


def drain(papers: DataFrame, summaries: DataFrame, pages: DataFrame | None, fn: Callable[[str, int], str],
          model_name: str, batch_size: int = 15, single_batch: bool = False,
          calls_per_minute: int | None = None, created_at=None, with_batches: bool = False,
          ledger_path: str | None = None, run_id: str | None = None,
          calls_per_write: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Returns (new summary rows, per-paper results). Failed papers leave no row and
    stay queued (D6). ``with_batches`` adds each paper's batch number (one extra
    numbering job). With ``ledger_path`` and ``run_id`` every answer is kept as it comes, and a
    drain that is started again under the same ``run_id`` asks only for what is missing."""
    prompts = queue_prompts(papers, summaries, pages, batch_size, single_batch)
    if ledger_path:
        if not run_id:
            raise ValueError("a ledger needs a run_id")
        results = ledger.summarize(prompts, fn, ledger_path, run_id, calls_per_minute=calls_per_minute,
                                   calls_per_write=calls_per_write)
    else:
        results = inference.summarize(prompts, fn, calls_per_minute=calls_per_minute)
    if single_batch:
        results = results.withColumn("batch_no", F.lit(0).cast("long"))
    elif with_batches:
        results = results.join(queue_batches(papers, summaries, batch_size), "id")
    rows = inference.summary_rows(results, papers, model_name, created_at=created_at, stored=summaries)
    return rows, results


def end_state(summaries: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Summary table after the drain (UNION ALL by name)."""
    cols = new_rows.columns
    old = summaries.select(F.col("arxiv_paper_id"), *[c for c in cols if c != "arxiv_paper_id"])
    return old.withColumn("source", F.lit("stored")).unionByName(new_rows.withColumn("source", F.lit("drained")))


def drain_loop(spark, papers: DataFrame, summaries_path: str, pages: DataFrame | None,
               fn: Callable[[str, int], str], model_name: str, batch_size: int = 15,
               single_batch: bool = False, max_batches: int | None = None,
               calls_per_minute: int | None = None) -> dict:
    """The source application's drain, batch by batch: take the queue head, summarize,
    append to the summaries table at ``summaries_path``; stop when the queue is empty,
    (papers that failed in this run are passed over and stay queued, D6), after one batch with
    ``single_batch``, or after ``max_batches``. Every step is a distributed job over at
    most ``batch_size`` papers; the loop only reads counters.

    Returns ``{"processed", "batches", "remaining"}`` with separate counters (D20)."""
    processed = batches = 0
    tried = scratch_path(spark, "drain-tried")  # one table of failed papers, so that the plan does not grow by batch
    spark.range(0).write.parquet(tried)
    while True:
        untried = papers.join(spark.read.schema("id long").parquet(tried), "id", "left_anti")
        summ = spark.read.parquet(summaries_path)
        if views.queue_depth(untried, summ).first()["remaining"] == 0:
            break
        rows, results = drain(untried, summ, pages, fn, model_name, batch_size, single_batch=True,
                        calls_per_minute=calls_per_minute)
        rows = rows.checkpoint(eager=True)
        n = rows.count()
        if n:
            rows.select(*summ.columns).write.mode("append").parquet(summaries_path)
        processed += n
        batches += 1
        results.filter(~F.col("ok")).select("id").coalesce(1).write.mode("append").parquet(tried)  # at most a batch
        if single_batch or (max_batches and batches >= max_batches):
            break
    remaining = views.queue_depth(papers, spark.read.parquet(summaries_path)).first()["remaining"]
    return {"processed": processed, "batches": batches, "remaining": remaining}
