"""T1 end state equals the batch ingest; replays add nothing. M1 retries and errors."""

from pyspark.sql import functions as F

from paperflow.operators import inference as INF
from paperflow.session import scratch_path
from paperflow.sources import feed as FD
from paperflow.sources import standins as S
from paperflow.streaming import ingest as SI


def test_stream_ingest_matches_batch_and_replays_nothing(spark, sf):
    table = scratch_path(spark, "t-table")
    stored = S.stored_papers(spark, sf).select(*SI.TABLE_COLUMNS)
    stored.write.parquet(table)
    inbox = scratch_path(spark, "t-inbox")
    FD.write_feed(S.papers(spark, sf), inbox)
    ck = scratch_path(spark, "t-ck")
    SI.start_ingest(spark, inbox, table, ck).awaitTermination()
    first = spark.read.parquet(table).count()
    SI.start_ingest(spark, inbox, table, ck).awaitTermination()     # nothing new
    assert spark.read.parquet(table).count() == first
    batch = FD.valid_papers(FD.entries_to_papers(FD.read_feed(spark, inbox)))
    expect = stored.select("arxiv_id").union(batch.select("arxiv_id")).distinct().count()
    assert first == expect


def test_summarize_retries_and_failures(spark):
    prompts = spark.createDataFrame([
        (1, "Title: abcd\n\nAbstract: " + "x" * 300),        # len 4 -> empty first answer, ok on 2nd
        (2, "Title: abcde\n\nAbstract: " + "y" * 300),       # len 5 -> raises twice, ok on 3rd
        (3, "Title: abc\n\nAbstract: short"),                # short abstract -> always invalid
        (4, "Title: ab\n\nAbstract: " + "z" * 300),          # ok on first
    ], "id long, prompt string")
    got = {r["id"]: r for r in INF.summarize(prompts, INF.echo_model).collect()}
    assert (got[1]["ok"], got[1]["attempts"]) == (True, 2)
    assert (got[2]["ok"], got[2]["attempts"]) == (True, 3)
    assert (got[3]["ok"], got[3]["attempts"]) == (False, 3) and got[3]["beginner_title"] is None
    assert (got[4]["ok"], got[4]["attempts"]) == (True, 1)
    papers = spark.createDataFrame([(i, f"k{i}") for i in range(1, 5)], "id long, arxiv_id string")
    res = INF.summarize(prompts, INF.echo_model)
    assert INF.summary_rows(res, papers, "m").count() == 3
    errs = INF.summary_rows(res, papers, "m", record_errors=True).filter(F.col("processing_status") == "error").collect()
    assert len(errs) == 1 and errs[0]["beginner_summary"] == INF.ERROR_SUMMARY


def test_call_lanes_stay_under_the_cap_of_the_job():
    for cores in (1, 3, 8, 40):
        for cap in (1, 7, 15, 100):
            lanes, each = INF.call_lanes(cores, cap)
            assert 1 <= lanes <= cores and each >= 1 and lanes * each <= cap
        assert INF.call_lanes(cores, None) == (cores, None)


def test_calls_are_dealt_to_lanes_and_empty_retries_not_run(spark):
    from pyspark import TaskContext
    prompts = spark.range(200).selectExpr("id", "concat('p', id) as prompt").coalesce(1)

    def lane(prompt, attempt):
        assert attempt == 1
        return "BEGINNER_TITLE: " + "\n\n".join(
            f"{f.upper()}: lane {TaskContext.get().partitionId()} answered this prompt at length" for f in INF.FIELDS
        )[len("BEGINNER_TITLE: "):]

    got = INF.summarize(prompts, lane, lanes=4).collect()
    assert len(got) == 200 and all(r["ok"] and r["attempts"] == 1 for r in got)
    assert len({r["beginner_title"] for r in got}) == 4


def test_a_lane_of_unknown_past_starts_full():
    assert len(INF._Pacer(3, used=True).times) == 3 and not INF._Pacer(None, used=True).times


def test_stream_ingest_into_day_folders(spark, sf):
    table, inbox, rejects = (scratch_path(spark, f"t-days-{x}") for x in ("table", "inbox", "rejects"))
    stored = S.stored_papers(spark, sf).withColumn("published_day", F.to_date("published_date"))
    stored.write.partitionBy("published_day").parquet(table)
    FD.write_feed(S.papers(spark, sf), inbox)
    for ck in ("a", "b"):  # the second stream replays the whole feed as its own first batch
        SI.start_ingest(spark, inbox, table, scratch_path(spark, f"t-days-{ck}"), rejects=rejects).awaitTermination()
        out = spark.read.parquet(table)
        rows = (out.count(), out.select("arxiv_id").distinct().count(), spark.read.parquet(rejects).count())
        first = rows if ck == "a" else first
        assert rows == first and rows[0] == rows[1] > stored.count()
    assert out.filter("extracted_at is null or created_at is null or published_day is null").count() == 0


def test_pacer_limits_calls():
    import time
    p = INF._Pacer(3)
    p.times.extend([time.monotonic() - 59.9] * 3)
    t0 = time.monotonic()
    p.wait()
    assert time.monotonic() - t0 >= 0.05


def test_drain_loop_batches_until_done_or_stalled(spark, sf):
    from paperflow.operators import views
    from paperflow.streaming import drain
    papers = S.papers(spark, sf)
    table = scratch_path(spark, "t-summ")
    # start from the stored summaries in the shape the drain appends
    seed = S.summaries(spark, sf)
    seed.write.parquet(table)
    depth0 = views.queue_depth(papers, spark.read.parquet(table)).first()[0]
    out = drain.drain_loop(spark, papers, table, None, INF.echo_model, "stub", batch_size=5, max_batches=2)
    assert out["batches"] <= 2 and out["processed"] <= 10
    assert out["remaining"] == depth0 - out["processed"]
    one = drain.drain_loop(spark, papers, table, None, INF.echo_model, "stub", batch_size=5, single_batch=True)
    assert one["batches"] == 1
    # the drained rows are whole rows that the export finds
    from paperflow.operators.views import latest_summaries
    all_rows = spark.read.parquet(table)
    assert all_rows.filter("id is null or created_at is null or updated_at is null").count() == 0
    assert all_rows.count() == all_rows.select("id").distinct().count()
    newest = latest_summaries(all_rows, papers, out["processed"] + one["processed"]).collect()
    assert {r["model_name"] for r in newest} == {"stub"}
