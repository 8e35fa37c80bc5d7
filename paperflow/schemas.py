"""Explicit schemas (no inference anywhere)."""

from pyspark.sql.types import (ArrayType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

_S = StringType()

ATOM_ENTRY = StructType([
    StructField("id", _S), StructField("title", _S), StructField("summary", _S),
    StructField("published", _S), StructField("updated", _S),
    StructField("author", ArrayType(StructType([StructField("name", _S)]))),
    StructField("category", ArrayType(StructType([StructField("_term", _S)]))),
    StructField("link", ArrayType(StructType([
        StructField("_href", _S), StructField("_type", _S), StructField("_rel", _S), StructField("_title", _S)]))),
])

PAPERS = StructType([
    StructField("id", LongType(), False), StructField("arxiv_id", _S, False),
    StructField("title", _S, False), StructField("abstract", _S, False),
    StructField("authors", ArrayType(_S), False), StructField("categories", ArrayType(_S), False),
    StructField("categories_name", ArrayType(_S), False),
    StructField("published_date", TimestampNTZType(), False), StructField("updated_date", TimestampNTZType(), False),
    StructField("pdf_url", _S, True), StructField("abstract_url", _S, False),
    StructField("extracted_at", TimestampNTZType(), True), StructField("created_at", TimestampNTZType(), True),
])

SUMMARIES = StructType([
    StructField("id", LongType(), False), StructField("arxiv_paper_id", LongType(), False),
    StructField("arxiv_id", _S, False),
    *[StructField(f, _S, False) for f in ("beginner_title", "intermediate_title", "beginner_overview",
                                          "intermediate_overview", "beginner_summary", "intermediate_summary")],
    StructField("processing_status", _S, True), StructField("processing_error", _S, True),
    StructField("model_name", _S, True),
    StructField("created_at", TimestampNTZType(), False), StructField("updated_at", TimestampNTZType(), False),
])

TAXONOMY = StructType([StructField("category_code", _S), StructField("category_name", _S)])
