"""Atom feed files (S1), entry -> paper projection (P1, X1-X9) and rejects.

The source application fetched one feed page over HTTP; here feeds are files read
by Spark's XML source with an explicit schema, so any number of files is scanned in
parallel and nothing is capped at 2000 entries (D23).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from paperflow.functions.dates import ntz_lit

from paperflow.functions import dates
from paperflow.functions.text import strip_ws, url_tail
from paperflow.operators.taxonomy import translate_categories
from paperflow.schemas import ATOM_ENTRY

PDF_TYPE = "application/pdf"


#: Beside the fields of an entry: why it cannot be read (null: it can), its own text, and its file.
_BROKEN, _RAW, _FILE = "broken", "raw_entry", "file_name"


def _entries(pieces: DataFrame) -> DataFrame:
    """Entries of feed files split in front of every ``<entry``. Each is parsed by itself, so one that is broken
    or cut off costs no other; what precedes a file's first entry starts with its own tag and is no entry."""
    piece, end = F.col("value"), F.instr("value", "</entry>")
    schema = StructType([*ATOM_ENTRY.fields, StructField("_malformed", StringType())])
    raw = F.concat(F.lit("<entry"), F.when(end > 0, F.substring(piece, F.lit(1), end + 7)).otherwise(piece))
    own = pieces.filter(F.regexp_like(piece, F.lit(r"^[\s>]")) & ~F.startswith(F.ltrim(piece), F.lit("<")) & (F.trim(piece) != "")).select(
        raw.alias(_RAW), F.when(end == 0, "cut off").alias("_cut"), F.col("_metadata.file_name").alias(_FILE))
    parsed = own.withColumn("_e", F.from_xml(_RAW, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}))
    broken = F.coalesce("_cut", F.when(F.col("_e._malformed").isNotNull(), "malformed"))
    fields = {f.name: F.col(f"_e.{f.name}") for f in ATOM_ENTRY.fields}
    # of a broken entry the parser may give no field; its id says which one to ask for again
    fields["id"] = F.coalesce(fields["id"], F.when(broken.isNotNull(), F.nullif(F.regexp_extract(_RAW, "<id>([^<]*)</id>", 1), F.lit(""))))
    return parsed.select(*[c.alias(n) for n, c in fields.items()], broken.alias(_BROKEN), _RAW, _FILE)


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``<entry>`` across every file under ``path``, broken ones too (``broken`` says why), with
    the entry's own text and the file's name. Large files are split like any text."""
    return _entries(spark.read.option("lineSep", "<entry").text(path))


def read_feed_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """S1 as a stream source: new files under ``path`` become new micro-batches."""
    r = spark.readStream.option("lineSep", "<entry")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return _entries(r.text(path))


def pdf_link(links: Column) -> Column:
    """Href of the first link typed as PDF; a link without a type is skipped."""
    return F.get(F.filter(links, lambda l: F.coalesce(l["_type"] == PDF_TYPE, F.lit(False))), 0)["_href"]


def entries_to_papers(entries: DataFrame, taxonomy: DataFrame | None = None,
                      extracted_at: dt.datetime | None = None) -> DataFrame:
    """P1 plus an ``is_valid`` flag (F12). Invalid rows keep their raw fields so they
    can be reported; ``valid_papers`` / ``rejected_entries`` split them."""
    authors = F.coalesce(F.transform("author", lambda a: a["name"]), F.array().cast("array<string>"))
    codes = F.coalesce(F.transform("category", lambda c: c["_term"]), F.array().cast("array<string>"))
    published = dates.parse_feed_ts(F.col("published"))
    updated = dates.parse_feed_ts(F.coalesce(F.col("updated"), F.col("published")))
    out = entries.select(
        url_tail("id").alias("arxiv_id"),
        strip_ws("title").alias("title"),
        strip_ws("summary").alias("abstract"),
        authors.alias("authors"),
        codes.alias("categories"),
        published.alias("published_date"),
        updated.alias("updated_date"),
        pdf_link(F.col("link")).alias("pdf_url"),
        F.col("id").alias("abstract_url"),
        ntz_lit(extracted_at).alias("extracted_at"),
        F.col("published").alias("raw_published"),
        *[F.col(c) if c in entries.columns else F.lit(None).cast("string").alias(c) for c in (_BROKEN, _RAW, _FILE)],
    )
    valid = (F.col(_BROKEN).isNull() & F.col("abstract_url").isNotNull() & F.col("title").isNotNull() & F.col("abstract").isNotNull()
             & F.col("published_date").isNotNull() & F.col("updated_date").isNotNull())
    out = out.withColumn("is_valid", valid).withColumn(_RAW, F.when(~F.col("is_valid"), F.col(_RAW)))
    if taxonomy is None:
        return out.withColumn("categories_name", F.col("categories"))
    return translate_categories(out, taxonomy, codes_col="categories", out_col="categories_name")


def valid_papers(parsed: DataFrame) -> DataFrame:
    return parsed.filter("is_valid").drop("is_valid", "raw_published", _BROKEN, _RAW, _FILE)


def rejected_entries(parsed: DataFrame) -> DataFrame:
    """the entries that are not papers, with the reason, their own text and their file."""
    reason = (F.when(F.col(_BROKEN).isNotNull(), F.concat(F.lit("entry is "), F.col(_BROKEN)))
              .when(F.col("abstract_url").isNull(), "missing id")
              .when(F.col("title").isNull() | F.col("abstract").isNull(), "missing text")
              .when(F.col("published_date").isNull(), "bad published date")
              .otherwise("bad updated date"))
    return parsed.filter(~F.col("is_valid")).select("abstract_url", "raw_published", reason.alias("reason"), _RAW, _FILE)


def feed_frame(papers: DataFrame) -> DataFrame:
    """Atom-shaped rows per paper, for writing feed files from a papers table.

    Shapes by id: every 11th has an unparsable published date; every 5th has no
    ``<updated>``; every 6th has an alternate link without a type; every 13th has no
    categories; papers without a PDF have no PDF link."""
    i = F.col("id")
    good = F.date_format("published_date", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    published = F.when(i % 11 == 0, F.date_format("published_date", "yyyy/MM/dd HH:mm:ss")).otherwise(good)
    updated = F.date_format(F.col("published_date") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    entry_id = F.concat(F.lit("http://files.example/abs/"), F.col("arxiv_id"))
    link = lambda href, rel, typ, title: F.struct(
        href.alias("_href"), F.lit(rel).alias("_rel"), typ.cast("string").alias("_type"), F.lit(title).cast("string").alias("_title"))
    alternate = link(entry_id, "alternate", F.when(i % 6 == 0, F.lit(None)).otherwise(F.lit("text/html")), None)
    pdf = link(F.col("pdf_url"), "related", F.lit(PDF_TYPE), "pdf")
    links = F.when(F.col("pdf_url").isNull(), F.array(alternate)).otherwise(F.array(alternate, pdf))
    return papers.select(
        entry_id.alias("id"),
        F.when(i % 5 == 0, F.lit(None).cast("string")).otherwise(updated).alias("updated"),
        published.alias("published"),
        F.col("title"),
        F.col("abstract").alias("summary"),
        F.transform("authors", lambda a: F.struct(a.alias("name"))).alias("author"),
        links.alias("link"),
        F.when(i % 13 == 0, F.lit(None)).otherwise(F.transform("categories", lambda c: F.struct(c.alias("_term")))).alias("category"),
    )


def write_feed(papers: DataFrame, path: str) -> str:
    """Writes Atom feed files (one ``<feed>`` document per partition) under ``path``."""
    (feed_frame(papers).write.mode("overwrite").format("xml")
     .option("rootTag", "feed").option("rowTag", "entry").save(path))
    return path
