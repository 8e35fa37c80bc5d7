"""Constraint audits (Q1-Q5) and the referential delete (J7). File tables do not
enforce UNIQUE, NOT NULL, length or foreign keys, so each becomes a report job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Declared column limits of the source schema.
LENGTH_LIMITS = {"arxiv_id": 50, "processing_status": 50, "model_name": 100}


def duplicate_keys(df: DataFrame, key: str, check: str) -> DataFrame:
    """Q1: keys that occur more than once (the count is partially aggregated)."""
    return (df.groupBy(F.col(key).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1).select(F.lit(check).alias("check_name"), "key", "n_rows"))


def null_counts(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Q2: one aggregation pass, then one row per column."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (one.unpivot([], columns, "column_name", "n_null")
            .select(F.lit(table).alias("table_name"), "column_name", F.col("n_null").cast("bigint")))


def length_report(df: DataFrame, table: str, limits: dict[str, int]) -> DataFrame:
    """Q4: per limited column the limit, the rows over it and the longest value."""
    cols = [c for c in limits if c in df.columns]
    aggs = []
    for c in cols:
        aggs += [F.count_if(F.char_length(c) > limits[c]).alias(f"{c}__over"),
                 F.max(F.char_length(c)).cast("bigint").alias(f"{c}__longest")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(limits[c]).cast("bigint").alias("max_len"),
                     F.col(f"{c}__over").cast("bigint").alias("n_over"), F.col(f"{c}__longest").alias("longest"))
            for c in cols]
    return one.select(F.lit(table).alias("table_name"), F.inline(F.array(*rows)))


def misaligned(papers: DataFrame) -> DataFrame:
    """Q5: code and name arrays of different length."""
    nc, nn = F.size("categories"), F.size("categories_name")
    return papers.filter(nc != nn).select("id", nc.cast("bigint").alias("n_codes"), nn.cast("bigint").alias("n_names"))


def orphans(summaries: DataFrame, papers: DataFrame) -> DataFrame:
    """Q3: summaries whose paper is gone."""
    return summaries.join(papers.select(F.col("id").alias("arxiv_paper_id")), "arxiv_paper_id", "left_anti")


def cascade_delete(summaries: DataFrame, deleted_ids: DataFrame) -> DataFrame:
    """Deleting papers deletes their summaries; returns the summaries that remain."""
    return summaries.join(deleted_ids.select(F.col("id").alias("arxiv_paper_id")), "arxiv_paper_id", "left_anti")
