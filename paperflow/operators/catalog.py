"""Tables and views (S6, K6, K7) and the in-place name backfill (K2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperflow.operators import taxonomy, views
from paperflow.schemas import PAPERS, SUMMARIES


def table_exists(spark: SparkSession, name: str) -> bool:
    """Catalog lookup instead of a probing query."""
    return spark.catalog.tableExists(name)


def _create(spark: SparkSession, name: str, location: str, schema, partition: str | None) -> None:
    if table_exists(spark, name):
        return
    empty = spark.createDataFrame([], schema)
    if partition:
        empty = empty.withColumn(partition, F.lit(None).cast("date"))
    w = empty.write.format("parquet").option("path", location)
    if partition:
        w = w.partitionBy(partition)
    w.saveAsTable(name)


def create_papers_table(spark: SparkSession, name: str, location: str) -> None:
    """K6: papers table partitioned by published day (stands in for the date index)."""
    _create(spark, name, location, PAPERS, "published_day")


def create_summaries_table(spark: SparkSession, name: str, location: str) -> None:
    _create(spark, name, location, SUMMARIES, None)


def register_views(spark: SparkSession, papers: DataFrame, summaries: DataFrame, as_of=None) -> None:
    """K7: the five stored views as temp views (Catalyst inlines them into queries). The paper
    views read newest first, so a bare limit takes the head (and plans as a top-k)."""
    if as_of is not None:
        views.newest_first(views.recent_papers(papers, as_of)).createOrReplaceTempView("recent_arxiv_papers")
    views.papers_by_category(papers, ordered=True).createOrReplaceTempView("arxiv_papers_by_category")
    views.papers_by_category_name(papers, ordered=True).createOrReplaceTempView("arxiv_papers_by_category_names")
    views.newest_first(views.papers_with_summaries(papers, summaries), key="paper_id").createOrReplaceTempView(
        "v_papers_with_summaries")
    views.newest_first(views.papers_needing_summaries(papers, summaries)).createOrReplaceTempView(
        "v_papers_needing_summaries")


def backfill_names_in_place(spark: SparkSession, path: str, taxonomy_df: DataFrame,
                            partition: str = "published_day") -> int:
    """K2: rewrite only the day partitions that hold rows needing names.

    Parquet tables refuse MERGE/UPDATE, so the touched partitions are recomputed,
    checkpointed (the rewrite must not read the files it replaces) and written back
    with dynamic partition overwrite. Returns the number of rows filled."""
    table = spark.read.parquet(path)
    n = F.col("categories_name")
    touched = (table.filter((n.isNull() | (F.size(n) == 0)) & (F.size("categories") > 0))
               .select(partition).distinct())
    days = touched.select(F.col(partition).alias("_day"))
    part = table.join(days, table[partition].eqNullSafe(days["_day"]), "left_semi")  # a NULL day is a partition too
    fixed = taxonomy.backfill_names(part, taxonomy_df).checkpoint(eager=True)
    filled = fixed.filter("names_filled").count()
    if filled:
        (fixed.drop("names_filled").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition).parquet(path))
    return filled
