"""Model hook (M1), queue step (M2) and summary rows.

The model is any Python callable ``fn(prompt: str, attempt: int) -> str``. Calls run
inside ``mapInPandas`` on the executors (Arrow batches in, one call per paper - the
model itself is per-paper). Retries are Spark passes, not Python loops: attempt k
runs only over the rows whose attempt k-1 gave an empty text, raised, or failed the
section check. Each attempt's output is checkpointed before it is parsed, so a task
retry or a lost executor never repeats model calls that already returned.
"""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperflow.functions.dates import ntz_lit, run_time

from paperflow.functions.sections import FIELDS, parse_responses
from paperflow.operators.numbering import global_row_number
from paperflow.session import checkpoint_root

# Fixed values of the source application.
MAX_ATTEMPTS = 3
ERROR_TITLE = "Error during processing"
ERROR_SUMMARY = "Summary generation failed"

#: Prompts of an Arrow batch. A worker holds a batch several times over (Arrow, pandas, the answers), whole texts each.
BATCH_ROWS = 128

CALL_SCHEMA = "id long, prompt string, attempt int, response string, error string"


class _Pacer:
    """Sliding 60 s window of a lane: at most ``per_minute`` calls (the W1 rule). ``used``
    starts with a full window, for a lane whose earlier calls are not known here."""

    def __init__(self, per_minute: int | None, used: bool = False):
        self.per_minute = per_minute
        self.times: deque[float] = deque([time.monotonic()] * per_minute if used and per_minute else [])

    def wait(self) -> None:
        if not self.per_minute:
            return
        now = time.monotonic()
        while self.times and now - self.times[0] >= 60:
            self.times.popleft()
        if len(self.times) >= self.per_minute:
            time.sleep(max(0.0, 60 - (now - self.times[0])))
            self.times.popleft()
        self.times.append(time.monotonic())


def _caller(fn: Callable[[str, int], str], attempt: int, per_minute: int | None):
    def run(batches):
        from pyspark import TaskContext
        task = TaskContext.get()
        pacer = _Pacer(per_minute, used=attempt > 1 or bool(task and task.attemptNumber()))
        for pdf in batches:
            texts, errors = [], []
            for prompt in pdf["prompt"]:
                pacer.wait()
                try:
                    texts.append(fn(prompt, attempt))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - any model failure is a retry
                    texts.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"id": pdf["id"], "prompt": pdf["prompt"], "attempt": attempt,
                                "response": texts, "error": errors})
    return run


def call_lanes(parallelism: int, calls_per_minute: int | None) -> tuple[int, int | None]:
    """Lanes of calls that run side by side, and the calls a minute of each: together they
    stay at or under the cap of the whole job."""
    if not calls_per_minute:
        return parallelism, None
    lanes = max(1, min(parallelism, calls_per_minute))
    return lanes, calls_per_minute // lanes


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside hand their Python workers BATCH_ROWS rows at a time, however many a lane has."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def summarize(prompts: DataFrame, fn: Callable[[str, int], str], max_attempts: int = MAX_ATTEMPTS,
              calls_per_minute: int | None = None, lanes: int | None = None) -> DataFrame:
    """M1: ``prompts`` (id, prompt) -> one row per id with ``ok``, ``attempts``, the six
    sections (when ok) and the last error.

    The cost of a row is its call, not its bytes, so rows are dealt to lanes by id (AQE would
    pack the small prompts into one task). ``lanes`` defaults to the cluster's cores;
    ``calls_per_minute`` caps the whole job. A pass with nothing to retry is not run."""
    spark = prompts.sparkSession
    checkpoint_root(spark)
    lanes, per_lane = call_lanes(lanes or spark.sparkContext.defaultParallelism, calls_per_minute)
    pending = prompts.select("id", "prompt").repartition(lanes, "id")
    done = None
    for attempt in range(1, max_attempts + 1):
        called = pending.mapInPandas(_caller(fn, attempt, per_lane), CALL_SCHEMA)
        parsed = parse_responses(called.withColumn("response", F.coalesce("response", F.lit(""))))
        parsed = parsed.withColumn("ok", F.col("is_valid") & F.col("error").isNull()).drop("is_valid")
        # Parse in the same stage as the calls, then cut the lineage: later filters read
        # the checkpoint (no regex re-evaluation, no repeated model calls). The prompt is
        # kept only for rows that need another attempt, so retries never recompute it.
        with small_batches(spark):
            parsed = parsed.withColumn("prompt", F.when(~F.col("ok"), F.col("prompt"))).checkpoint(eager=True)
        last = attempt == max_attempts
        finished = parsed if last else parsed.filter("ok")
        done = finished if done is None else done.unionByName(finished)
        if not last:
            pending = parsed.filter(~F.col("ok")).select("id", "prompt")
            if pending.isEmpty():
                break
    reason = F.when(F.col("ok"), F.lit(None)).otherwise(F.coalesce(F.col("error"), F.lit("invalid or empty response")))
    return done.select("id", "ok", F.col("attempt").alias("attempts"),
                       *[F.when(F.col("ok"), F.col(f"sections.{f}")).alias(f) for f in FIELDS],
                       reason.alias("error"))


def summary_rows(results: DataFrame, papers: DataFrame, model_name: str, record_errors: bool = False,
                 created_at=None, stored: DataFrame | None = None) -> DataFrame:
    """Summary-table rows for the successful results. With ``record_errors`` a
    failed paper gets an ``error`` row with the fixed texts, which removes it from the
    queue for good (D21); by default failures leave no row and stay queued (D6).

    ``created_at`` and ``updated_at`` are one time per run. Ids continue after the largest
    of ``stored`` in the order of the papers' ids (W3), numbered on the ids alone."""
    r = results if record_errors else results.filter("ok")
    p = papers.select(F.col("id"), "arxiv_id")
    start = stored.agg(F.max("id")).first()[0] or 0 if stored is not None and "id" in stored.columns else 0
    numbers = global_row_number(r.select("id"), [F.col("id")])
    j = r.join(p, "id").join(numbers, "id")
    now = ntz_lit(created_at or run_time())
    text = lambda f: F.when(F.col("ok"), F.col(f)).otherwise(
        F.lit(ERROR_SUMMARY if f.endswith("summary") else ERROR_TITLE))
    return j.select(
        (F.lit(start).cast("long") + F.col("rn")).alias("summary_id"), F.col("id").alias("arxiv_paper_id"), "arxiv_id",
        *[text(f).alias(f) for f in FIELDS],
        F.when(F.col("ok"), "completed").otherwise("error").alias("processing_status"),
        F.when(~F.col("ok"), F.col("error")).alias("processing_error"),
        F.lit(model_name).alias("model_name"),
        now.alias("created_at"), now.alias("updated_at"),
    ).withColumnRenamed("summary_id", "id")


def echo_model(prompt: str, attempt: int) -> str:
    """Deterministic offline stand-in for a hosted model, used by tests and the
    registered queries. It answers from the prompt's title and abstract lines.

    - title length % 4 == 0: empty answer on attempt 1 (retried)
    - title length % 4 == 1: raises on attempts 1 and 2 (succeeds on the third)
    - abstract shorter than 200 characters: never writes the last header (always fails)
    """
    lines = prompt.split("\n")
    title = lines[0][len("Title: "):] if lines and lines[0].startswith("Title: ") else ""
    abstract = lines[2][len("Abstract: "):] if len(lines) > 2 and lines[2].startswith("Abstract: ") else ""
    if len(title) % 4 == 0 and attempt == 1:
        return ""
    if len(title) % 4 == 1 and attempt < 3:
        raise RuntimeError("service unavailable")
    parts = [
        "BEGINNER_TITLE: Plain words: " + title[:40],
        "INTERMEDIATE_TITLE: Technical: " + title[:60],
        "BEGINNER_OVERVIEW: In short: " + abstract[:120],
        "INTERMEDIATE_OVERVIEW: In detail: " + abstract[:160],
        "BEGINNER_SUMMARY: Summary: " + abstract[:600],
    ]
    if len(abstract) >= 200:
        parts.append("INTERMEDIATE_SUMMARY: Details: " + abstract[:900])
    return "\n\n".join(parts)
