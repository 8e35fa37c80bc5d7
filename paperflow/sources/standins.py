"""Paper-shaped views over the driver's generic tables.

The driver ships TPC-H-like tables plus ``documents``/``labels``/``nation``/
``conversations``/``events``/``pages``. These functions derive the paper,
summary and taxonomy tables from them with pure column expressions (no shuffle
except the summaries join), so every registered query scales with the input.
The same definitions exist as DuckDB SQL in ``paperflow.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperflow import params
from paperflow.sources.tables import read_table


def arxiv_id_of(doc_id: Column) -> Column:
    return F.concat(F.lit("2401."), F.lpad(doc_id.cast("string"), F.greatest(F.lit(6), F.length(doc_id.cast("string"))), F.lit("0")), F.lit("v1"))


#: Where a text's six parts end, in hundredths of its characters; the last one takes the rest.
PART_ENDS = (5, 10, 25, 40, 70)


def parts_of(text: Column, first: Column | None = None) -> list[Column]:
    """Six parts that add up to the text. ``first`` sets the length of the first one."""
    n = F.char_length(text)
    ends = [F.floor(n * k / 100).cast("int") for k in PART_ENDS]
    if first is not None:
        ends = [F.least(n, first)] + [F.greatest(F.least(n, first), e) for e in ends[1:]]
    starts = [F.lit(0), *ends]
    return [F.substring(text, a + 1, b - a) for a, b in zip(starts, [*ends, n])]


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    published = F.expr(
        "timestamp_ntz'2024-01-01 00:00:00' + "
        "make_dt_interval(cast(doc_id % 60 as int), 0, cast((doc_id * 37) % 1440 as int), 0)"
    )
    return d.select(
        F.col("doc_id").alias("id"),
        arxiv_id_of(F.col("doc_id")).alias("arxiv_id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("abstract"),
        F.expr("transform(sequence(1L, 1 + doc_id % 5), i -> concat('Author ', cast(i as string)))").alias("authors"),
        F.array("lang", "source").alias("categories"),
        F.when(F.col("doc_id") % 9 == 0, F.array().cast("array<string>"))
        .otherwise(F.array(F.col("lang"), F.concat(F.lit("NATION_"), F.substring("source", 4, 1 << 20))))
        .alias("categories_name"),
        published.alias("published_date"),
        published.alias("updated_date"),
        F.when(F.col("doc_id") % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("http://files.example/pdf/"), F.col("doc_id").cast("string")))
        .alias("pdf_url"),
        F.concat(F.lit("http://files.example/abs/"), F.col("doc_id").cast("string")).alias("abstract_url"),
        (published + F.expr("INTERVAL 1 DAY")).alias("extracted_at"),
        (published + F.expr("INTERVAL 1 DAY")).alias("created_at"),
    )


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = read_table(spark, sf_dir, "labels", "doc_id", "toxic")
    doc = read_table(spark, sf_dir, "documents", "doc_id", "text")
    created = F.expr("timestamp_ntz'2024-03-01 00:00:00' + make_dt_interval(0, cast(doc_id % 100 as int), 0, 0)")
    part = parts_of(F.col("text"))
    return lab.join(doc, "doc_id").select(
        (F.col("doc_id") * 3 + 7).alias("id"),  # its own id: a join on the wrong key must show
        F.col("doc_id").alias("arxiv_paper_id"),
        arxiv_id_of(F.col("doc_id")).alias("arxiv_id"),
        part[0].alias("beginner_title"),
        part[1].alias("intermediate_title"),
        part[2].alias("beginner_overview"),
        part[3].alias("intermediate_overview"),
        part[4].alias("beginner_summary"),
        part[5].alias("intermediate_summary"),
        F.when(F.col("toxic") == 1, "error").otherwise("completed").alias("processing_status"),
        F.when(F.col("toxic") == 1, "flagged by moderation").alias("processing_error"),
        F.lit("stub-model").alias("model_name"),
        created.alias("created_at"),
        created.alias("updated_at"),
    )


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return n.select(
        F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("category_code"),
        F.col("n_name").alias("category_name"),
    )


def stored_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows already in the papers table: everything published before ``STORED_BEFORE``."""
    return papers(spark, sf_dir).filter(F.col("published_date") < F.lit(params.STORED_BEFORE).cast("timestamp_ntz"))


def deleted_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers withdrawn from the store: the ones that never had a PDF link."""
    return papers(spark, sf_dir).filter(F.col("pdf_url").isNull()).select("id")


def page_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted page text, one row per (doc_id, page)."""
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    return c.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), "text")


def old_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries in the pre-migration shape: easy/layman/university columns, some blank."""
    s = summaries(spark, sf_dir)
    blank = lambda c, m: F.when(F.col("id") % m == 0, F.lit("")).when(F.col("id") % m == 1, F.lit(None).cast("string")).otherwise(c)
    return s.select(
        "id", "arxiv_paper_id", "arxiv_id",
        blank(F.col("beginner_title"), 6).alias("easy_title"),
        blank(F.col("beginner_summary"), 7).alias("layman_summary"),
        F.col("intermediate_summary").alias("university_summary"),
        "processing_status", "created_at",
    )


def dirty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document text with control characters and Unicode spaces injected, plus NULLs."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text")
    t = F.col("text")
    dirty = F.concat(
        F.lit("  \t"),
        F.replace(
            F.replace(F.replace(t, F.lit(". "), F.lit(". \u3000\u00a0\u2003 ")), F.lit(","), F.lit(",\x07\x01")),
            F.lit("\n"), F.lit("\n\u0085\r\n"),
        ),
        F.lit("\u200b\x1f  "),
    )
    return d.select("doc_id", F.when(F.col("doc_id") % 13 == 0, F.lit(None).cast("string")).otherwise(dirty).alias("text"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model responses assembled from the six parts of the whole document text with the six headers.

    ``doc_id % 8`` picks a shape: 0-3 well formed; 4 writes the intermediate overview
    header with a space; 5 puts a blank line inside the last summary; 6 drops the
    beginner summary header; 7 uses bold markers, a lower-case header and a title of
    9 characters. Newlines inside the parts are replaced by spaces.
    """
    d = read_table(spark, sf_dir, "documents", "doc_id", "text")
    flat = F.replace(F.col("text"), F.lit("\n"), F.lit(" "))
    v = F.col("doc_id") % 8
    n = F.char_length(flat)
    p = parts_of(flat, first=F.when(v == 7, F.lit(9)).otherwise(F.floor(n * PART_ENDS[0] / 100).cast("int")))
    t1 = F.when(v == 7, F.lit("**BEGINNER_TITLE:** ")).otherwise(F.lit("BEGINNER_TITLE: "))
    h3 = F.when(v == 7, F.lit("beginner_overview: ")).otherwise(F.lit("BEGINNER_OVERVIEW: "))
    h4 = F.when(v == 4, F.lit("INTERMEDIATE OVERVIEW: ")).otherwise(F.lit("INTERMEDIATE_OVERVIEW: "))
    h5 = F.when(v == 6, F.lit("")).otherwise(F.lit("BEGINNER_SUMMARY: "))
    last = F.when(v == 5, F.concat(F.substring(p[5], 1, 40), F.lit("\n\n"), F.substring(p[5], F.lit(41), n))).otherwise(p[5])
    resp = F.concat(
        t1, p[0], F.lit("\n\nINTERMEDIATE_TITLE: "), p[1],
        F.lit("\n\n"), h3, p[2],
        F.lit("\n\n"), h4, p[3],
        F.lit("\n\n"), h5, p[4],
        F.lit("\n\nINTERMEDIATE_SUMMARY: "), last,
    )
    return d.select("doc_id", resp.alias("response"))


def feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fetched feed: every paper once, and every fourth paper a second time with a
    later ``updated_date`` and revised title (copies the de-duplication must resolve)."""
    p = papers(spark, sf_dir)
    rev = (p.filter(F.col("id") % 4 == 0)
           .withColumn("title", F.concat("title", F.lit(" [rev]")))
           .withColumn("updated_date", F.col("updated_date") + F.expr("INTERVAL 1 DAY")))
    cols = ["arxiv_id", "title", "abstract", "authors", "categories", "categories_name",
            "published_date", "updated_date", "pdf_url", "abstract_url"]
    return p.select(*cols).unionByName(rev.select(*cols))


def summaries_with_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current-shape summaries where some overviews were never written."""
    s = summaries(spark, sf_dir)
    return (s.withColumn("beginner_overview", F.when(F.col("id") % 5 == 0, F.lit("")).otherwise(F.col("beginner_overview")))
            .withColumn("intermediate_overview",
                        F.when(F.col("id") % 5 == 1, F.lit(None).cast("string")).otherwise(F.col("intermediate_overview"))))


def text_date(ts: Column, doc_id: Column) -> Column:
    """A time as sources write it; ``doc_id % 6`` picks the form. 5 is no date."""
    form = lambda f: F.date_format(ts, f)
    v = doc_id % 6
    return (F.when(v == 0, form("yyyy-MM-dd")).when(v == 1, form("yyyy-MM-dd HH:mm:ss"))
            .when(v == 2, F.concat(form("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:00")))
            .when(v == 3, F.concat(form("yyyy-MM-dd'T'HH:mm:ss"), F.lit(".250Z")))
            .when(v == 4, F.lit(None).cast("string")).otherwise(F.concat(F.lit("around "), form("yyyy"))))


def faulty_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed whose entries break the store's constraints here and there: no title, an id that is too long,
    fewer names than codes, no time."""
    f = feed_rows(spark, sf_dir)
    tail = F.substring_index(F.substring_index("arxiv_id", "v", 1), ".", -1).cast("long")
    none = F.lit(None).cast("string")
    return f.withColumns({
        "title": F.when(tail % 17 == 0, none).otherwise(F.col("title")),
        "updated_date": F.when(tail % 31 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("updated_date")),
        "categories_name": F.when(tail % 23 == 0, F.slice("categories_name", 1, 1)).otherwise(F.col("categories_name")),
        "arxiv_id": F.when(tail % 19 == 0, F.rpad("arxiv_id", 51, "x")).otherwise(F.col("arxiv_id")),
    })
