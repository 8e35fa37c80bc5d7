"""K1 idempotence, D3 de-duplication, exact global numbering under a hot key."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from paperflow.operators import ingest as IN
from paperflow.operators.numbering import global_row_number
from paperflow.sources import standins as S


def test_numbering_matches_row_number_with_hot_day(spark):
    # a third of the rows share one day and one timestamp
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(dt.datetime(2024, 1, 1))).otherwise(
            F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(F.col("id") % 50)).alias("published_date"),
        F.format_string("k%06d", (F.col("id") * 7919) % n).alias("arxiv_id"))
    got = global_row_number(df, [F.col("published_date"), F.col("arxiv_id")], partitions=16)
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("published_date", "arxiv_id")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_dedup_prefers_latest_update_then_smallest_url(spark):
    rows = [("k", "t1", dt.datetime(2024, 1, 1), "b"), ("k", "t2", dt.datetime(2024, 1, 2), "c"),
            ("k", "t3", dt.datetime(2024, 1, 2), "a"), ("j", "t4", dt.datetime(2024, 1, 1), "z")]
    df = spark.createDataFrame(rows, "arxiv_id string, title string, updated_date timestamp_ntz, abstract_url string")
    got = {r["arxiv_id"]: r["title"] for r in IN.dedup_feed(df).collect()}
    assert got == {"k": "t3", "j": "t4"}


def test_ingest_twice_equals_once(spark, sf):
    feed, stored = S.feed_rows(spark, sf), S.stored_papers(spark, sf)
    once = IN.ingest(feed, stored).checkpoint(eager=True)
    twice = IN.ingest(feed, once)
    assert twice.count() == once.count()
    ids = once.select("id")
    assert ids.distinct().count() == ids.count()
    mx, mn, n = once.agg(F.max("id"), F.min("id"), F.count("id")).first()
    new = once.join(stored.select("arxiv_id"), "arxiv_id", "left_anti")
    start = stored.agg(F.max("id")).first()[0]
    lo, hi, k = new.agg(F.min("id"), F.max("id"), F.count("id")).first()
    assert lo == start + 1 and hi == start + k        # dense after the stored maximum


def test_append_papers_writes_new_rows_only(spark, sf):
    from paperflow.session import scratch_path
    path = scratch_path(spark, "t-papers")
    stored = S.stored_papers(spark, sf)
    stored.withColumn("published_day", F.to_date("published_date")).write.partitionBy("published_day").parquet(path)
    n1 = IN.append_papers(S.feed_rows(spark, sf), spark.read.parquet(path).drop("published_day"), path)
    n2 = IN.append_papers(S.feed_rows(spark, sf), spark.read.parquet(path).drop("published_day"), path)
    total = spark.read.parquet(path)
    assert n1 > 0 and n2 == 0
    assert total.count() == total.select("arxiv_id").distinct().count()
