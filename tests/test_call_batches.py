"""the model's workers get a bounded number of prompts at a time, however many a lane has."""

import pandas as pd
from pyspark.sql import functions as F

from paperflow.operators import inference, ledger
from paperflow.session import scratch_path

SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _sizes(fn, attempt, per_minute):
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "prompt": pdf["prompt"], "attempt": attempt, "response": None,
                                "error": str(len(pdf))}).astype({"response": "object"})
    return run


def test_batches_of_the_model_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(inference, "_caller", _sizes)
    before = spark.conf.get(SETTING)
    prompts = spark.range(1000).select("id", F.lit("Title: t").alias("prompt"))
    for got in (inference.summarize(prompts, None, max_attempts=1, lanes=1),
                ledger.summarize(prompts, None, scratch_path(spark, "ledger"), "r", max_attempts=1, lanes=1)):
        sizes = [int(r["error"]) for r in got.collect()]
        assert len(sizes) == 1000 and max(sizes) <= inference.BATCH_ROWS
    assert spark.conf.get(SETTING) == before
