"""Stored tables that change: tombstones and compaction (J7), migration (K8), batches with reserved ids."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paperflow.operators import batches as B
from paperflow.operators import catalog as CT
from paperflow.operators import migrate as M
from paperflow.operators import tombstones as TB
from paperflow.session import scratch_path
from paperflow.sources import standins as S


def files(spark, path):
    return {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()}


def ids(df, c="id"):
    return sorted(r[0] for r in df.select(c).collect())


def test_compaction_rewrites_only_touched_folders(spark):
    path, graves = scratch_path(spark, "t-table"), scratch_path(spark, "t-graves")
    rows = [(1, "2024-01-01"), (2, "2024-01-01"), (3, "2024-01-02"), (4, "2024-01-03"), (5, "2024-01-03"), (6, None), (7, None)]
    spark.createDataFrame(rows, "id long, day string").selectExpr("id", "to_date(day) day").repartition(1).write.partitionBy("day").parquet(path)
    assert ids(TB.living(spark.read.parquet(path), TB.buried(spark, graves))) == [1, 2, 3, 4, 5, 6, 7]
    assert TB.compact(spark, path, TB.buried(spark, graves), "day") == {"folders": 0, "removed": 0}
    for _ in range(2):  # a repeated batch of deletes
        TB.bury(spark.createDataFrame([(2,), (3,), (3,), (7,), (99,), (None,)], "id long"), graves, "b1")
    dead = TB.buried(spark, graves)
    before = files(spark, path)
    assert ids(dead, "paper_id") == [2, 3, 7, 99]
    assert ids(TB.living(spark.read.parquet(path), dead)) == [1, 4, 5, 6]
    assert TB.compact(spark, path, dead, "day") == {"folders": 3, "removed": 3}
    after = spark.read.schema("id long, day date").parquet(path)
    assert ids(after) == [1, 4, 5, 6] == ids(TB.living(after, dead))
    kept = {f for f in before if "2024-01-03" in f}
    assert len(kept) == 1 and kept <= files(spark, path) and not (before - kept) & files(spark, path)
    assert TB.compact(spark, path, dead, "day") == {"folders": 0, "removed": 0}
    TB.bury(spark.createDataFrame([(1,), (4,), (5,), (6,)], "id long"), graves, "b2")
    TB.compact(spark, path, TB.buried(spark, graves), "day")
    assert spark.read.parquet(path).count() == 0


def old_table(spark, sf):
    at = scratch_path(spark, "t-old")
    name = at.rsplit("/", 1)[1].replace("-", "_")
    S.old_summaries(spark, sf).write.format("parquet").option("path", at).saveAsTable(name)
    return name, at


def test_a_refused_migration_leaves_the_old_table(spark, sf):
    name, at = old_table(spark, sf)
    before, columns, had = spark.table(name).count(), spark.table(name).columns, files(spark, at)
    with pytest.raises(M.MigrationRefused) as e:
        M.migrate_table(spark, name, scratch_path(spark, "t-new"))
    assert e.value.nulls["beginner_summary"] > 0 and e.value.nulls["beginner_title"] == 0
    assert (spark.table(name).count(), spark.table(name).columns, files(spark, at)) == (before, columns, had)
    assert not spark.catalog.tableExists(f"{name}__new") and not spark.catalog.tableExists(f"{name}__old")


def test_the_name_switches_to_the_migrated_rows(spark, sf):
    name, at = old_table(spark, sf)
    to, had = scratch_path(spark, "t-new"), files(spark, at)
    spark.sql(f"CREATE TEMP VIEW v_{name} AS SELECT id FROM {name}")
    nulls = M.migrate_table(spark, name, to, required=tuple(M.PLACEHOLDERS))
    assert set(nulls.values()) == {0}
    table = spark.table(name)
    assert "beginner_title" in table.columns and "easy_title" not in table.columns
    assert table.filter("beginner_title is null or beginner_title = ''").count() == 0
    assert table.count() == S.old_summaries(spark, sf).count() == spark.table(f"v_{name}").count()
    assert files(spark, to) and files(spark, at) == had  # the old files are still there
    again = M.migrate_table(spark, name, scratch_path(spark, "t-newer"), required=tuple(M.PLACEHOLDERS))  # new shape: no change
    assert again == nulls and spark.table(name).exceptAll(spark.read.parquet(to)).count() == 0
    CT.register_views(spark, S.papers(spark, sf), spark.table(name).withColumn("model_name", F.lit("m")))
    spark.sql(f"DROP TABLE {name}")


def paper(k, day=1, url="u"):
    t = dt.datetime(2024, 1, day)
    return (f"k{k}", "t", "a", ["x"], ["c"], ["n"], t, t, None, url)


FEED = ("arxiv_id string, title string, abstract string, authors array<string>, categories array<string>, "
        "categories_name array<string>, published_date timestamp_ntz, updated_date timestamp_ntz, pdf_url string, abstract_url string")


def feed(spark, *rows):
    return spark.createDataFrame(list(rows), FEED)


def stored(spark, root):
    return sorted((r["batch_id"], r["id"], r["arxiv_id"]) for r in B.read_papers(spark, root).collect())


def test_a_stopped_batch_runs_again_with_the_same_ids(spark):
    root = scratch_path(spark, "t-batches")
    assert B.append_batch(feed(spark, paper(2), paper(1), paper(1)), root, 1, "w") == {"inserted": 2, "first_id": 1}
    second = feed(spark, paper(1), paper(5, 3), paper(4, 2), paper(5, 3, "z"))
    B.append_batch(second, root, 2, "w", commit=False)
    assert stored(spark, root) == [(1, 1, "k1"), (1, 2, "k2")]  # written, not visible
    with pytest.raises(B.BatchConflict):
        B.append_batch(feed(spark, paper(9)), root, 3, "w")
    with pytest.raises(B.BatchConflict):
        B.append_batch(second, root, 2, "another writer")
    with pytest.raises(B.BatchConflict):
        B.append_batch(feed(spark, paper(9)), root, 2, "w")  # not the batch that was begun
    assert B.append_batch(second, root, 2, "w") == {"inserted": 2, "first_id": 3}
    want = [(1, 1, "k1"), (1, 2, "k2"), (2, 3, "k4"), (2, 4, "k5")]
    assert stored(spark, root) == want
    assert B.append_batch(second, root, 2, "w") == {"inserted": 0, "first_id": 3} and stored(spark, root) == want
    assert B.append_batch(second, root, 3, "x") == {"inserted": 0, "first_id": 5}  # nothing new: an empty range
    assert B.append_batch(feed(spark, paper(9)), root, 4, "x") == {"inserted": 1, "first_id": 5}
    assert stored(spark, root) == [*want, (4, 5, "k9")]


def test_stops_at_every_step_leave_no_gap_and_no_copy(spark, monkeypatch):
    root, rows = scratch_path(spark, "t-batches"), feed(spark, *(paper(k, 1 + k % 5) for k in range(20)))
    for at in ("checkpoint", "reserve", "with_defaults"):
        def lost(*args, **kw):
            raise InterruptedError(at)
        with monkeypatch.context() as m:
            if at == "checkpoint":
                m.setattr(B.ingest, "dedup_feed", lost)
            elif at == "reserve":
                m.setattr(B, "reserve", lost)
            else:
                m.setattr(B.ingest, "with_defaults", lost)  # after the range is reserved
            with pytest.raises(InterruptedError):
                B.append_batch(rows, root, 1, "w")
        assert stored(spark, root) == []
    B.append_batch(rows, root, 1, "w")
    assert [r[1] for r in stored(spark, root)] == list(range(1, 21))


def test_numbering_sorts_and_checkpoints_narrow_rows_only(spark, monkeypatch):
    from paperflow.operators import ingest
    seen = []
    real = ingest.global_row_number
    monkeypatch.setattr(ingest, "global_row_number", lambda df, order: seen.append(df.columns) or real(df, order))
    out = ingest.assign_ids(feed(spark, paper(3), paper(1, 2)), spark.range(5))
    assert seen == [["published_date", "arxiv_id"]]
    assert sorted((r["arxiv_id"], r["id"]) for r in out.collect()) == [("k1", 6), ("k3", 5)]
