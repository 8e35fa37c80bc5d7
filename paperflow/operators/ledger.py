"""Answer ledger of the model hook (M1, M2): a drain that dies pays for no answer twice.

The ledger is an append-only table of (run_id, paper_id, prompt_sha256, attempt, response, error). Every
answer is written there before anything is parsed. A run first judges what the ledger holds for its prompts:
a good answer to the same prompt counts, whichever run got it; failed attempts count within their own run,
so a restart of a run goes on where it stopped and a new run tries anew. Only the rest is asked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from paperflow.functions.sections import FIELDS, parse_responses
from paperflow.operators import inference
from paperflow.session import checkpoint_root

LEDGER = StructType([
    StructField("run_id", StringType()), StructField("paper_id", LongType()), StructField("prompt_sha256", StringType()),
    StructField("attempt", IntegerType()), StructField("response", StringType()), StructField("error", StringType())])


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; an empty one is created where there is none."""
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def judged(asked: DataFrame, ledger: DataFrame, run_id: str) -> DataFrame:
    """Per asked paper (id, prompt_sha256): ``ok``, the attempt and sections of its good answer, the attempts
    used in this run and the last error. Only the asked prompts' answers are parsed."""
    mine = ledger.withColumnRenamed("paper_id", "id").join(asked.select("id", "prompt_sha256"), ["id", "prompt_sha256"], "left_semi")
    parsed = parse_responses(mine.withColumn("response", F.coalesce("response", F.lit(""))))
    ok = F.col("is_valid") & F.col("error").isNull()
    own = F.col("run_id") == run_id
    best = parsed.groupBy("id").agg(
        F.coalesce(F.max(F.when(own, F.col("attempt"))), F.lit(0)).alias("used"),
        # the earliest good answer; ties (two writers) by its text
        F.min(F.when(ok, F.struct("attempt", "run_id", "sections"))).alias("good"),
        F.max_by(F.when(own, F.coalesce("error", F.lit("invalid or empty response"))), F.when(own, F.col("attempt"))).alias("last_error"))
    return asked.select("id").join(best, "id", "left").select(
        "id", F.col("good").isNotNull().alias("ok"), F.coalesce("used", F.lit(0)).alias("used"),
        F.col("good.attempt").alias("good_attempt"), "good.sections", "last_error")


def summarize(prompts: DataFrame, fn: Callable[[str, int], str], path: str, run_id: str,
              max_attempts: int = inference.MAX_ATTEMPTS, calls_per_minute: int | None = None, lanes: int | None = None,
              calls_per_write: int | None = None) -> DataFrame:
    """M1 over the ledger at ``path``: the rows of ``inference.summarize`` and ``reused`` (no call was made for
    the paper). ``calls_per_write`` bounds the answers that a dying run can lose: each write is a job over about
    that many papers (default: an attempt's papers in one write).

    A null prompt counts as empty; prompts with equal ids are one paper. An empty queue gives no rows.
    """
    spark = prompts.sparkSession
    checkpoint_root(spark)
    lanes, per_lane = inference.call_lanes(lanes or spark.sparkContext.defaultParallelism, calls_per_minute)
    text = F.coalesce("prompt", F.lit(""))
    asked = prompts.groupBy("id").agg(F.min(text).alias("prompt")).withColumn(
        "prompt_sha256", F.sha2("prompt", 256)).checkpoint(eager=True)
    read_ledger(spark, path)
    open_ids = asked.select("id", "prompt_sha256")
    state = judged(open_ids, read_ledger(spark, path), run_id).checkpoint(eager=True)
    done = state.filter("ok").withColumn("reused", F.lit(True))
    state = state.filter("not ok")
    spent = state.filter(F.col("used") >= max_attempts).withColumn("reused", F.lit(True))
    for attempt in range(1, max_attempts + 1):
        todo = asked.join(state.filter(F.col("used") == attempt - 1).select("id"), "id", "left_semi")
        waiting = state.filter((F.col("used") != attempt - 1) & (F.col("used") < max_attempts))
        n = todo.count()
        if not n:
            continue
        slices = -(-n // calls_per_write) if calls_per_write else 1
        for k in range(slices):
            part = todo if slices == 1 else todo.filter(F.pmod(F.xxhash64("id"), F.lit(slices)) == k)
            called = part.select("id", "prompt").repartition(lanes, "id").mapInPandas(
                inference._caller(fn, attempt, per_lane), inference.CALL_SCHEMA)
            with inference.small_batches(spark):
                called.select(F.lit(run_id).alias("run_id"), F.col("id").alias("paper_id"), F.sha2("prompt", 256).alias("prompt_sha256"),
                              "attempt", "response", "error").write.mode("append").parquet(path)
        now = judged(todo.select("id", "prompt_sha256"), read_ledger(spark, path), run_id).checkpoint(eager=True)
        fresh = now.withColumn("reused", F.lit(False))
        done = done.unionByName(fresh.filter("ok"))
        spent = spent.unionByName(fresh.filter(~F.col("ok") & (F.col("used") >= max_attempts)))
        state = waiting.unionByName(now.filter(~F.col("ok") & (F.col("used") < max_attempts)))
    ok = F.col("ok")
    return done.unionByName(spent).select(
        "id", "ok", F.when(ok, F.col("good_attempt")).otherwise(F.col("used")).alias("attempts"),
        *[F.when(ok, F.col(f"sections.{f}")).alias(f) for f in FIELDS],
        F.when(~ok, F.coalesce("last_error", F.lit("invalid or empty response"))).alias("error"), "reused")
