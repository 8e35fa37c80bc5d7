"""Properties from the test strategy, plus randomized text against Python."""

import string

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperflow.functions import text as TX
from paperflow.operators import views
from paperflow.sources import standins as S
from tests.test_text import py_clean, py_trunc

ALPHABET = st.sampled_from(list(string.ascii_letters + " \t\n\r\x0b\x0c") +
                           ["\x00", "\x07", "\x1c", "\x1f", "\x7f", "\x85", "\x9f", "\xa0", "\u1680",
                            "\u2003", "\u200b", "\u2028", "\u202f", "\u205f", "\u3000", "\u00e9", "\u4e2d",
                            "\U0001F600"])


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=40)), min_size=30, max_size=60))
def test_clean_and_truncate_random(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", TX.clean_text("t").alias("c"), TX.truncate_text("t", 7).alias("k")).orderBy("i").collect()
    assert [r["c"] for r in got] == [py_clean(t) for t in texts]
    assert [r["k"] for r in got] == [py_trunc(t, 7) for t in texts]


def test_queue_and_summarized_partition_linked_papers(spark, sf):
    papers, summ = S.papers(spark, sf), S.summaries(spark, sf)
    linked = papers.filter(F.col("pdf_url").isNotNull()).select("id")
    queue = views.papers_needing_summaries(papers, summ).select("id")
    done = linked.join(summ.select(F.col("arxiv_paper_id").alias("id")), "id", "left_semi")
    assert queue.join(done, "id").count() == 0
    assert queue.union(done).exceptAll(linked).count() == 0 and linked.exceptAll(queue.union(done)).count() == 0


def test_category_counts_sum_to_zipped_elements(spark, sf):
    papers = S.papers(spark, sf)
    total = papers.select(F.sum(F.greatest(F.size("categories"), F.size("categories_name")))).first()[0]
    counted = views.papers_by_category(papers).select(F.sum("paper_count")).first()[0]
    assert counted == total
