"""F1 (pipeline): what the Python workers of an executor hold does not grow with a partition's rows."""

import sys

import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from paperflow.llm import common, line_dedup, mixing

SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_passages_come_in_small_batches(spark):
    most, before = common.BATCH_ROWS, spark.conf.get(SETTING)

    def digest(chunk: bytes) -> bytes:
        rows = sys._getframe(1).f_locals["batch"].num_rows
        if rows > most:
            raise AssertionError(f"a batch of {rows} rows")
        return xxhash.xxh3_128_digest(chunk)

    text = F.concat(F.lit("the same line of words in all the texts\nand another line of words\nnumber "), F.col("id"))
    docs = spark.range(3 * most, numPartitions=1).select(F.col("id").alias("doc_id"), text.alias("text"))
    left = {r["doc_id"]: r["text"] for r in line_dedup.passage_dedup(docs, digest).select("doc_id", "text").collect()}
    assert left.pop(0).count("\n") == 2
    assert left == {k: f"number {k}" for k in range(1, 3 * most)}
    assert spark.conf.get(SETTING) == before


def test_pieces_hold_all_rows_in_order():
    batch = pa.RecordBatch.from_arrays([pa.array(range(2 * common.BATCH_ROWS + 5))], ["x"])
    got = list(common.pieces(iter([batch, batch.slice(0, 0)])))
    assert [b.num_rows for b in got] == [common.BATCH_ROWS, common.BATCH_ROWS, 5]
    assert [x for b in got for x in b.column(0).to_pylist()] == batch.column(0).to_pylist()


def test_plan_of_the_mix_needs_no_python_workers(spark, capsys):
    narrow = spark.createDataFrame([(1, "a", 30, 5), (2, None, 20, 7)], "doc_id long, source string, _size long, _at long")
    plan = mixing.source_plan(narrow, 4, 17)
    assert {r["_source"]: r["source_size"] for r in plan.collect()} == {"a": 30, None: 20}
    plan.explain()
    assert "RDD" not in capsys.readouterr().out
