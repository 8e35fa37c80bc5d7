"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperflow.llm import (
    chat_format, collocations, exact_dedup, hard_negatives, line_dedup, mixing, near_dedup, quality_rules, secrets, sentencepiece_codec, sharding, sql,
    substring_dedup, toxicity,
)
from paperflow.sources.tables import read_table

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return line_dedup.report(line_dedup.passage_dedup(docs, least_words=line_dedup.LEAST_WORDS))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read_table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_digests(read_table(spark, sf_dir, "documents"), MODEL)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(read_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents")).drop("keep_locator")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(read_table(spark, sf_dir, "documents")).drop("key")


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    turns = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.digests(chat_format.format_chats(chat_format.records_of(turns))).drop("schema_sha256")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(read_table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(read_table(spark, sf_dir, "documents"), shards=16)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents", "lang", "text")).drop("k")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    label, ident = F.col("label").cast("long"), F.col("vec_id")
    vectors = vectors.withColumn("label", F.when(ident % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.hard_negatives(vectors, ident % 50 == 0)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_quality_rules, op3_sentencepiece, op4_mixing, op5_toxicity, op6_exact_dedup, op7_near_dedup,
    op8_chat_formatting, op9_secrets, op10_sharding, op11_collocations, op12_hard_negatives, op13_substring_dedup,
    pipeline)}
ORACLE_SQL = dict(sql.QUERIES)
