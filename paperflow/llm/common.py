"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperflow.session import scratch_path

# The ASCII white space [\x20\x09-\x0D] that separates words in every operator here.
WHITESPACE = " \t\n\x0b\f\r"
#: Rows of an Arrow batch with whole texts. The executor and its Python worker each hold a batch, often several times over.
BATCH_ROWS = 1024


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside hand their Python workers BATCH_ROWS rows at a time."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of BATCH_ROWS rows, so that what a worker makes of them stays small. For steps that
    are started elsewhere, whose batches have as many rows as the session says."""
    for batch in batches:
        for k in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(k, BATCH_ROWS)


def words_of(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text, in order; null or blank text has none.

    Literal replacements and one literal split, all without a regular expression.
    """
    spaced = F.coalesce(text, F.lit(""))
    for c in WHITESPACE[1:]:
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(spaced, " "), "")


def without_whitespace(text: Column) -> Column:
    """The text with every character of [\\x20\\x09-\\x0D] deleted; null counts as empty."""
    bare = F.coalesce(text, F.lit(""))
    for c in WHITESPACE:
        bare = F.replace(bare, F.lit(c), F.lit(""))
    return bare


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder (``spark.checkpoint.dir``) and read it back.

    Cuts the lineage and computes ``df`` once when it is read several times; lost executors
    cost nothing because the files are in shared storage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_columns(df: DataFrame, **cols: Column) -> DataFrame:
    """``withColumns``: an input column that has an output's name is replaced."""
    return df.withColumns(cols)


def staged_once(df: DataFrame, name: str) -> DataFrame:
    """``staged``, and the shuffle files of ``df`` go as soon as the table stands.

    For a ``df`` that nothing else reads, so that a chain of steps holds one step's shuffle files
    and the staged tables at a time. The table itself survives lost executors.
    """
    conf = df.sparkSession.conf
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(setting, "false")
    conf.set(setting, "true")
    try:
        return staged(df, name)
    finally:
        conf.set(setting, before)


def documents_as_rows(docs: DataFrame) -> DataFrame:
    """``row`` (all columns as one struct, so that no name of theirs can clash), ``doc`` and ``key``.

    Documents are told apart by doc_id and text and come in the order of (doc, key): by doc_id,
    null last; rows with equal doc_id and text count as one document.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"),
        F.xxhash64(text, F.col("doc_id").isNull()).alias("key"))
