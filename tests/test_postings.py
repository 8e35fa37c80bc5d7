"""F7/A1 on the inverted code table: kept up by appends, read by the folders of the codes asked for."""

import datetime as dt

from pyspark.sql import functions as F

from paperflow.operators import postings as P
from paperflow.operators import views
from paperflow.operators.search import search_papers
from paperflow.session import scratch_path

T = dt.datetime(2024, 1, 5, 12)
SCHEMA = "id long, categories array<string>, categories_name array<string>, published_date timestamp_ntz"


def papers(spark, lo, hi):
    codes = [["a"], ["a", "a", "b"], [], None, ["c", None], ["b", "x/y z"]]
    return spark.createDataFrame([(k, codes[k % 6], codes[k % 6], T + dt.timedelta(hours=k)) for k in range(lo, hi)], SCHEMA)


def table(spark):
    path = scratch_path(spark, "t-postings")
    assert P.read_postings(spark, path).count() == 0 and P.counts_by_code(P.read_postings(spark, path)).count() == 0
    for batch, (lo, hi) in {1: (0, 10), 2: (10, 40), 3: (40, 41)}.items():
        P.append_postings(papers(spark, lo, hi), path, batch)
    P.append_postings(papers(spark, 10, 40), path, 2)  # a repeated batch
    return path


def test_counts_equal_the_view_after_three_appends(spark):
    got = {tuple(r) for r in P.counts_by_code(P.read_postings(spark, table(spark))).collect()}
    view = views.papers_by_category(papers(spark, 0, 41)).filter("category_id is not null").groupBy("category_id").agg(
        F.sum("paper_count"), F.max("latest_paper"))
    assert got == {tuple(r) for r in view.collect()} and len(got) == 4


def test_search_reads_only_the_folders_of_its_codes(spark):
    path, every = table(spark), papers(spark, 0, 41)
    postings = P.read_postings(spark, path)
    start, end = T + dt.timedelta(hours=2), T + dt.timedelta(hours=30)
    for codes, page in ((("a", "x/y z"), {}), (("b",), {"offset": 2, "max_results": 3}), (("none",), {}), (("c", "a"), {"max_results": 1})):
        want = [r["id"] for r in search_papers(every, start, end, codes, **page).collect()]
        assert [r["id"] for r in P.search_papers(every, postings, start, end, codes, **page).collect()] == want
        assert [r["id"] for r in P.search_ids(postings, start, end, codes, **page).collect()] == want
    ids = P.search_ids(postings, start, end, ("b",))
    assert {f.rsplit("/", 2)[1] for f in ids.inputFiles()} >= {"code=b"}
    plan = ids._jdf.queryExecution().toString()
    assert "PartitionFilters: [code" in plan.replace("isnotnull(code#", "code") or "code#" in plan.split("PartitionFilters: ")[1].split("]")[0]
    read = postings.filter(F.col("code").isin("b")).select(F.input_file_name()).distinct().collect()
    assert read and all("/code=b/" in r[0] for r in read)
