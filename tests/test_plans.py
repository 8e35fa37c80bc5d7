"""Physical-plan checks: anti join, pushdown, pruning, top-k, partial aggregation."""

from paperflow.operators import views
from paperflow.sources import standins as S


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_queue_is_anti_join(spark, sf):
    p = _plan(views.papers_needing_summaries(S.papers(spark, sf), S.summaries(spark, sf)))
    assert "LeftAnti" in p


def test_scan_prunes_columns(spark, sf):
    df = S.papers(spark, sf).select("id", "published_date")
    p = _plan(df)
    assert "ReadSchema: struct<doc_id:bigint>" in p


def test_topk_is_take_ordered(spark, sf):
    p = _plan(views.queue_head(S.papers(spark, sf), S.summaries(spark, sf), 15))
    assert "TakeOrderedAndProject" in p


def test_category_counts_partial_aggregation(spark, sf):
    p = _plan(views.papers_by_category(S.papers(spark, sf)))
    assert p.count("HashAggregate") >= 2 or "partial_count" in p


def test_label_filter_pushed(spark, sf):
    from pyspark.sql import functions as F
    from paperflow.sources.tables import read_table
    df = read_table(spark, sf, "labels", "doc_id", "toxic").filter(F.col("toxic") == 1)
    assert "PushedFilters: [IsNotNull(toxic), EqualTo(toxic,1)]" in _plan(df)


def test_stored_table_day_filter_prunes_and_pushes(spark, sf):
    import datetime as dt

    from pyspark.sql import functions as F

    from paperflow.operators import search
    from paperflow.session import scratch_path
    path = scratch_path(spark, "t-stored")
    S.papers(spark, sf).withColumn("published_day", F.to_date("published_date")).write.partitionBy(
        "published_day").parquet(path)
    t = spark.read.parquet(path)
    df = search.papers_on_day(t, dt.date(2024, 1, 15)).select("id", "published_date")
    p = _plan(df)
    assert "PartitionFilters: [isnotnull(published_day" in p
    assert "GreaterThanOrEqual(published_date,2024-01-15T00:00)" in p
    assert "ReadSchema: struct<id:bigint,published_date:timestamp_ntz>" in p
    want = S.papers(spark, sf).filter(F.to_date("published_date") == dt.date(2024, 1, 15)).count()
    assert df.count() == want


def test_numbering_single_partition_only_over_partition_counts(spark, sf):
    import __spark_entry__ as E
    df = E.queries()["assign_ids"](spark, sf)
    df.write.format("noop").mode("overwrite").save()
    lines = _plan(df).split("\n")
    idx = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert idx, "expected the offsets exchange"
    for i in idx:
        below = "\n".join(lines[i + 1:i + 4])
        assert "HashAggregate(keys=[_pid" in below


def test_category_report_order(spark, sf):
    rows = views.papers_by_category_name(S.papers(spark, sf), ordered=True).collect()
    counts = [r.paper_count for r in rows]
    assert counts == sorted(counts, reverse=True)
