"""K8 migration shapes, F13, Q audits, J7, K4 export write, S6/K6/K7 catalog ops."""

from pyspark.sql import functions as F

from paperflow.operators import export, migrate, quality
from paperflow.sources import standins as S


def test_migration_old_and_new_shape(spark):
    old = spark.createDataFrame([(1, "", None, "u"), (2, "Easy", "lay", None)],
                                "id long, easy_title string, layman_summary string, university_summary string")
    m = {r["id"]: r for r in migrate.migrate_summaries(old).collect()}
    assert m[1]["beginner_title"] == "Beginner title pending regeneration"
    assert m[1]["beginner_summary"] is None                      # not filled (D18)
    assert m[2]["beginner_title"] == "Easy" and m[2]["intermediate_summary"] is None
    assert m[2]["beginner_overview"] == "Overview pending regeneration"
    new = migrate.migrate_summaries(spark.createDataFrame([(3, "T", "T2", "o", "", "s", "s2")],
        "id long, beginner_title string, intermediate_title string, beginner_overview string, "
        "intermediate_overview string, beginner_summary string, intermediate_summary string"))
    r = new.first()
    assert r["beginner_overview"] == "o" and r["intermediate_overview"] == "Overview pending regeneration"
    assert migrate.pending_regeneration(new).count() == 1


def test_cascade_and_orphans_partition_summaries(spark, sf):
    summ, deleted = S.summaries(spark, sf), S.deleted_papers(spark, sf)
    kept_papers = S.papers(spark, sf).join(deleted, "id", "left_anti")
    a = quality.cascade_delete(summ, deleted).count()
    b = quality.orphans(summ, kept_papers).count()
    assert a + b == summ.count()


def test_export_write_overwrite_and_append(spark, sf):
    from paperflow.session import scratch_path
    rows = export.export_latest(S.summaries(spark, sf), S.papers(spark, sf), 5)
    path = scratch_path(spark, "t-export")
    assert export.write_export(rows, path) == 5
    assert export.write_export(rows, path, append=True) == 5
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    assert back.count() == 10 and back.columns == list(export.EXPORT_COLUMNS)


def test_catalog_tables_and_views(spark, sf):
    from paperflow.operators import catalog
    from paperflow.session import scratch_path
    loc = scratch_path(spark, "t-table")
    assert not catalog.table_exists(spark, "pf_papers")
    catalog.create_papers_table(spark, "pf_papers", loc)
    assert catalog.table_exists(spark, "pf_papers")
    catalog.register_views(spark, S.papers(spark, sf), S.summaries(spark, sf))
    n = spark.sql("SELECT count(*) FROM v_papers_needing_summaries").first()[0]
    assert n == S.papers(spark, sf).filter(F.col("pdf_url").isNotNull()).join(
        S.summaries(spark, sf).select(F.col("arxiv_paper_id").alias("id")), "id", "left_anti").count()
    spark.sql("DROP TABLE pf_papers")


def test_backfill_in_place_rewrites_touched_days(spark, sf):
    from paperflow.operators import catalog
    from paperflow.session import scratch_path
    path = scratch_path(spark, "t-backfill")
    p = S.papers(spark, sf).withColumn("published_day", F.to_date("published_date"))
    p.write.partitionBy("published_day").parquet(path)
    need = p.filter(F.size("categories_name") == 0).count()
    filled = catalog.backfill_names_in_place(spark, path, S.taxonomy(spark, sf))
    after = spark.read.parquet(path)
    assert filled == need and after.count() == p.count()
    assert after.filter(F.size("categories_name") == 0).count() == 0
    assert catalog.backfill_names_in_place(spark, path, S.taxonomy(spark, sf)) == 0


def test_optional_behaviors(spark, sf):
    from paperflow.operators import taxonomy, views
    from paperflow.operators.numbering import batch_numbers
    from paperflow.session import scratch_path
    p = spark.createDataFrame([(1, ["a"], ["a"]), (2, ["b"], []), (3, ["c"], ["Cee"])],
                              "id long, categories array<string>, categories_name array<string>")
    assert {r.id for r in taxonomy.needs_names(p).collect()} == {2}
    assert {r.id for r in taxonomy.needs_names(p, include_untranslated=True).collect()} == {1, 2}
    papers, summ = S.papers(spark, sf), S.summaries(spark, sf)
    q0 = views.papers_needing_summaries(papers, summ).count()
    q1 = views.papers_needing_summaries(papers, summ, requeue_errors=True).count()
    errs = summ.filter(F.col("processing_status") == "error").join(
        papers.filter(F.col("pdf_url").isNotNull()).select(F.col("id").alias("arxiv_paper_id")), "arxiv_paper_id").count()
    assert q1 == q0 + errs
    b = batch_numbers(spark.range(40).withColumnRenamed("id", "k"), [F.col("k")], 15, per_day=25)
    assert {(r.k, r.batch_no, r.day_no) for r in b.filter("k in (0, 14, 15, 24, 25, 39)").collect()} == {
        (0, 0, 0), (14, 0, 0), (15, 1, 0), (24, 1, 0), (25, 1, 1), (39, 2, 1)}
    rows = export.export_latest(summ, papers, 5)
    path = scratch_path(spark, "t-export2")
    assert export.write_export(rows, path) == 5
    assert export.write_export(rows, path, append=True, skip_existing=True) == 0


def test_category_counts_parallel_unnest_edge_cases(spark):
    import duckdb

    from paperflow.operators import views
    rows = [(1, ["a", "b"], ["x"]), (2, [], []), (3, ["a", "a"], ["x", "x"]), (4, ["c"], [])]
    df = spark.createDataFrame([(i, c, n, None) for i, c, n in rows],
                               "id long, categories array<string>, categories_name array<string>, published_date timestamp_ntz")
    got = [(r.category_name, r.category_id, r.paper_count) for r in views.papers_by_category(df).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE p (categories VARCHAR[], categories_name VARCHAR[])")
    con.executemany("INSERT INTO p VALUES (?, ?)", [(c, n) for _, c, n in rows])
    want = sorted(con.execute(
        "SELECT category_name, category_id, count(*) FROM (SELECT unnest(categories_name) AS category_name, "
        "unnest(categories) AS category_id FROM p) GROUP BY ALL").fetchall(), key=lambda r: tuple(str(x) for x in r))
    assert sorted(got, key=lambda r: tuple(str(x) for x in r)) == want


def test_drain_single_batch(spark, sf):
    from paperflow.operators import inference
    from paperflow.streaming import drain
    rows, res = drain.drain(S.papers(spark, sf), S.summaries(spark, sf), S.page_table(spark, sf),
                            inference.echo_model, "stub", batch_size=3, single_batch=True)
    assert res.count() == 3 and res.select("batch_no").distinct().first()[0] == 0
    assert rows.count() == res.filter("ok").count()


def test_daily_run_end_to_end(spark, sf):
    import datetime as dt

    from paperflow.operators import daily, inference
    from paperflow.session import scratch_path
    from paperflow.sources import feed as FD
    papers = S.papers(spark, sf)
    stored = S.stored_papers(spark, sf).withColumn("published_day", F.to_date("published_date"))
    table = scratch_path(spark, "t-daily-papers")
    stored.write.partitionBy("published_day").parquet(table)
    feed_path = FD.write_feed(papers, scratch_path(spark, "t-daily-feed"))
    summ = scratch_path(spark, "t-daily-summ")
    S.summaries(spark, sf).write.parquet(summ)
    as_of = dt.date(2024, 2, 13)                       # a Tuesday -> target day 2024-02-12
    out = daily.daily_run(spark, feed_path, table, S.taxonomy(spark, sf), as_of, summaries_path=summ,
                          model_fn=inference.echo_model, model_name="stub", summarize_limit=5)
    day = papers.filter(F.to_date("published_date") == dt.date(2024, 2, 12))
    ok_day = day.filter(F.col("id") % 11 != 0)
    assert out["first_day"] == out["last_day"] == "2024-02-12"
    assert out["kept"] == ok_day.count() and out["inserted"] == ok_day.count()
    assert out["rejected"] == papers.filter(F.col("id") % 11 == 0).count()
    assert out["summarized"] <= 5
    rejects, history = scratch_path(spark, "t-daily-rejects"), scratch_path(spark, "t-daily-history")
    for _ in range(2):  # a repeated run replaces its own rejects and its own row of the history
        again = daily.daily_run(spark, feed_path, table, S.taxonomy(spark, sf), as_of, rejects_path=rejects, history_path=history)
    assert spark.read.parquet(rejects).filter("raw_entry like '<entry>%' and file_name is not null").count() == out["rejected"]
    assert [tuple(r) for r in spark.read.parquet(history).select(*daily.COUNTERS).collect()] == [tuple(again[c] for c in daily.COUNTERS)]
    assert again["inserted"] == 0 and again["names_filled"] == 0
    assert daily.target_day_of(dt.date(2024, 2, 12)) == dt.date(2024, 2, 9)   # Monday -> Friday
    rng = daily.daily_run(spark, feed_path, table, S.taxonomy(spark, sf), as_of, days_back=3)
    span = papers.filter(F.to_date("published_date").between(dt.date(2024, 2, 9), dt.date(2024, 2, 12)))
    assert rng["kept"] == span.filter(F.col("id") % 11 != 0).count()
    assert rng["inserted"] == rng["kept"] - out["inserted"]
    one = daily.daily_run(spark, feed_path, table, S.taxonomy(spark, sf), as_of, day="2024-01-05")
    assert one["first_day"] == "2024-01-05" and one["inserted"] == 0      # stored already


def test_export_summaries_driver(spark, sf):
    from paperflow.session import scratch_path
    path = scratch_path(spark, "t-export3")
    assert export.export_summaries(S.summaries(spark, sf), S.papers(spark, sf), path, limit=3, append=False) == 3
    none = S.summaries(spark, sf).filter("false")
    assert export.export_summaries(none, S.papers(spark, sf), scratch_path(spark, "t-export4")) == 0
