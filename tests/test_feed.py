"""S1/P1/F12 on a hand-written Atom file."""

import datetime as dt
import os

from pyspark.sql import functions as F

from paperflow.sources import feed as FD

HERE = os.path.join(os.path.dirname(__file__), "fixtures", "feed_golden.xml")


def test_feed_rows(spark):
    tax = spark.createDataFrame([("cs.AI", "Artificial Intelligence")], "category_code string, category_name string")
    parsed = FD.entries_to_papers(FD.read_feed(spark, HERE), tax, extracted_at=dt.datetime(2024, 1, 5))
    good = {r["arxiv_id"]: r for r in FD.valid_papers(parsed).collect()}
    assert set(good) == {"2401.00001v1", "0101001v2", "2401.00004v1"}
    a = good["2401.00001v1"]
    assert a["title"].startswith("A plain") and a["title"].endswith("entry")
    assert a["abstract"] == "Abstract & more."
    assert a["authors"] == ["Ada Lovelace", "Alan Turing"]
    assert a["categories"] == ["cs.AI", "cs.LG"]
    assert a["categories_name"] == ["Artificial Intelligence", "cs.LG"]
    assert a["pdf_url"] == "http://arxiv.org/pdf/2401.00001v1"
    assert a["published_date"] == dt.datetime(2024, 1, 1, 9, 30)
    assert a["updated_date"] == dt.datetime(2024, 1, 2, 10, 0)
    b = good["0101001v2"]
    assert b["authors"] == ["Solo Author"] and b["categories"] == [] and b["pdf_url"] is None
    assert b["updated_date"] == b["published_date"]
    c = good["2401.00004v1"]
    assert c["pdf_url"] == "http://arxiv.org/pdf/2401.00004v1" and c["authors"] == []
    rej = FD.rejected_entries(parsed).collect()
    assert [(r["abstract_url"], r["reason"]) for r in rej] == [("http://arxiv.org/abs/2401.00003v1", "bad published date")]


def test_write_then_read_round_trip(spark, sf):
    from paperflow.session import scratch_path
    from paperflow.sources import standins as S
    papers = S.papers(spark, sf)
    path = FD.write_feed(papers, scratch_path(spark, "t-feed"))
    back = FD.valid_papers(FD.entries_to_papers(FD.read_feed(spark, path)))
    n_bad = papers.filter(F.col("id") % 11 == 0).count()
    assert back.count() == papers.count() - n_bad


GOOD = "<entry><id>http://x/abs/{0}</id><title>t {0}</title><summary>s</summary><published>2024-01-01T00:00:00Z</published></entry>"


def broken_files(folder):
    files = {"whole.xml": "<feed xmlns='http://www.w3.org/2005/Atom'>" + GOOD.format(1) + GOOD.format(2).replace("<entry>", "<entry xml:lang='en'>") + "</feed>",
             "bad.xml": "<?xml version='1.0'?>\n<feed>\n" + GOOD.format(3) + GOOD.format(4).replace("t 4", "t & 4") + "\n" + GOOD.format(5) + "</feed>",
             "cut.xml": "<feed>" + GOOD.format(6) + GOOD.format(7)[:60], "empty.xml": "", "header.xml": "<?xml version='1.0'?>\n<feed>\n</feed>\n",
             "short.xml": "<feed>" + GOOD.format(8)[:-len("</entry>")]}
    for name, text in files.items():
        (folder / name).write_text(text)
    return str(folder)


def test_a_broken_entry_costs_no_other(spark, tmp_path):
    parsed = FD.entries_to_papers(FD.read_feed(spark, broken_files(tmp_path)))
    assert sorted(r["title"] for r in FD.valid_papers(parsed).collect()) == ["t 1", "t 2", "t 3", "t 5", "t 6"]
    rejects = {r["file_name"]: r for r in FD.rejected_entries(parsed).collect()}
    assert {f: (r["abstract_url"], r["reason"]) for f, r in rejects.items()} == {
        "bad.xml": ("http://x/abs/4", "entry is malformed"), "cut.xml": ("http://x/abs/7", "entry is cut off"),
        "short.xml": ("http://x/abs/8", "entry is cut off")}
    assert rejects["bad.xml"]["raw_entry"] == GOOD.format(4).replace("t 4", "t & 4")
    assert rejects["cut.xml"]["raw_entry"] == GOOD.format(7)[:60]


def test_the_stream_sets_broken_entries_aside(spark, tmp_path):
    from paperflow.session import scratch_path
    from paperflow.sources import standins as S
    from paperflow.streaming import ingest as SI
    table, rejects = scratch_path(spark, "t-table"), scratch_path(spark, "t-rejects")
    S.stored_papers(spark, "/root/testdata/sf0.001").select(*SI.TABLE_COLUMNS, "created_at").limit(1).write.parquet(table)
    SI.start_ingest(spark, broken_files(tmp_path), table, scratch_path(spark, "t-ck"), rejects=rejects).awaitTermination()
    assert spark.read.parquet(table).filter("arxiv_id in ('1', '2', '3', '5', '6')").count() == 5
    assert spark.read.parquet(rejects).filter("raw_entry like '<entry>%' and reason like 'entry is %'").count() == 3
