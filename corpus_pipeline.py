"""Corpus pipeline: toxic documents go, repeated passages go, one of each near-duplicate group stays,
sources are mixed to their weights, and the mix is tokenized."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from paperflow.llm import line_dedup, mixing, near_dedup, sentencepiece_codec, toxicity
from paperflow.llm.common import staged
from paperflow.sources.tables import read_table

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go (operator 5); their columns stay as they are."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of two lines and ten words or more are cut out of the texts (operator 1); no document is
    dropped, null and empty texts stay as they are, an empty table stays empty."""
    return line_dedup.passage_dedup(docs, least_words=line_dedup.LEAST_WORDS).select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (operator 7, with shingles of five words)."""
    return near_dedup.keep_one(docs, length=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (operator 4)."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts (operator 3)."""
    return sentencepiece_codec.encode_digests(docs, MODEL)


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("near_dedup", dedup_near),
          ("mixing", mix_sources), ("sentencepiece", tokenize)]
#: No SQL: a trained classifier and a seeded mix stand between input and result (see tests/llm).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{name}")
    return docs
