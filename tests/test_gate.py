"""Q1-Q5 at the write: good rows are stored, the others set aside with their reasons, in one pass."""

from pyspark.sql import functions as F

from paperflow.operators import gate as G
from paperflow.operators import ingest
from paperflow.session import scratch_path
from paperflow.sources import standins as S


def table_of(spark, rows):
    path = scratch_path(spark, "t-gated")
    rows.withColumn("published_day", F.to_date("published_date")).write.partitionBy("published_day").parquet(path)
    return path


def test_good_rows_are_stored_and_a_repeat_changes_nothing(spark, sf):
    stored, feed = S.stored_papers(spark, sf), S.faulty_feed(spark, sf)
    path, aside = table_of(spark, stored), scratch_path(spark, "t-quarantine")
    first = G.gated_append(feed, stored, path, aside, "b1")
    assert first["kept"] + first["quarantined"] == feed.count() and 0 < first["inserted"] <= first["kept"]
    after = spark.read.parquet(path)
    assert after.filter("title is null or updated_date is null or length(arxiv_id) > 50").count() == 0
    again = G.gated_append(feed, after.drop("published_day"), path, aside, "b1")
    assert again == first | {"inserted": 0} and spark.read.parquet(aside).count() == first["quarantined"]
    assert spark.read.parquet(path).count() == after.count()


def test_one_pass_over_the_input(spark, sf, monkeypatch):
    """The input is read once, by the write of both sides."""
    reads = spark.sparkContext.accumulator(0)

    def counting(batches):
        for b in batches:
            reads.add(len(b))
            yield b

    feed = S.faulty_feed(spark, sf)
    counted = feed.mapInPandas(counting, feed.schema)
    monkeypatch.setattr(ingest, "append_papers", lambda good, *_: good.count())
    G.gated_append(counted, S.stored_papers(spark, sf), "-", scratch_path(spark, "t-quarantine"), "b")
    assert reads.value == feed.count()


def test_empty_and_every_reason(spark, sf):
    feed = S.feed_rows(spark, sf)
    empty = feed.limit(0)
    aside = scratch_path(spark, "t-quarantine")
    good, counts = G.gate(empty, G.paper_reasons(empty), aside, "b")
    assert good.count() == 0 and counts == {"kept": 0, "quarantined": 0}
    row = feed.limit(1).withColumns({c: F.lit(None).cast(t) for c, t in feed.dtypes})
    reasons = row.select(G.paper_reasons(row)).first()[0]
    assert reasons == [f"{c} is null" for c in G.REQUIRED_PAPER]
    assert "abstract is null" in feed.drop("abstract").select(G.paper_reasons(feed.drop("abstract"))).first()[0]


def test_summaries_need_their_paper_and_come_once(spark, sf):
    papers, s = S.papers(spark, sf), S.summaries(spark, sf).checkpoint(eager=True)
    path, aside = scratch_path(spark, "t-summ"), scratch_path(spark, "t-quarantine")
    n = s.count()
    s.filter("arxiv_paper_id % 2 = 0").write.parquet(path)
    stored = spark.read.parquet(path)
    before = stored.count()
    batch = s.unionByName(s.filter("arxiv_paper_id % 5 = 1").withColumn("id", F.col("id") + 1_000_000)).unionByName(
        s.limit(1).withColumns({"arxiv_paper_id": F.lit(-4).cast("long"), "id": F.lit(-1).cast("long")})).unionByName(
        s.limit(1).withColumns({"arxiv_paper_id": F.lit(None).cast("long"), "model_name": F.repeat(F.lit("m"), 101)}))
    counts = G.gated_summaries(batch, papers, stored, path, aside, "b")
    after = spark.read.parquet(path)
    assert after.count() == n and after.select("arxiv_paper_id").distinct().count() == n and counts["kept"] == n - before
    why = {r[0]: r[1] for r in spark.read.parquet(aside).groupBy(F.array_join("reasons", "; ")).count().collect()}
    assert why["no such paper"] == 1 and why["arxiv_paper_id is null; model_name is longer than 100"] == 1
    assert sum(why.values()) == counts["quarantined"] == batch.count() - counts["kept"]
