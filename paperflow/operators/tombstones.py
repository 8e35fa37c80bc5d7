"""Deletes on stored tables (J7): tombstones that the readers honour, and a compaction.

A delete appends the papers' ids under its batch. Readers leave out the papers and, as the reference asks
(a paper's delete deletes its summary), their summaries. The compaction rewrites the folders that hold dead
rows and no other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from paperflow.session import checkpoint_root

TOMBSTONES = StructType([StructField("paper_id", LongType())])


def bury(deleted: DataFrame, path: str, batch_id: str) -> None:
    """Tombstones for ``deleted`` (id); a repeated batch replaces its own. Null ids bury nothing."""
    ids = deleted.select(F.col("id").cast("long").alias("paper_id")).filter("paper_id is not null").distinct()
    ids.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def buried(spark: SparkSession, path: str) -> DataFrame:
    """The distinct ids under every batch; none where nothing was ever deleted."""
    spark.createDataFrame([], TOMBSTONES).write.mode("ignore").parquet(path)
    return spark.read.schema(TOMBSTONES).parquet(path).filter("paper_id is not null").select("paper_id").distinct()


def living(rows: DataFrame, tombstones: DataFrame, paper_id: str = "id") -> DataFrame:
    """The rows whose paper is not buried: papers by ``id``, summaries by ``arxiv_paper_id``. A row without the
    id stays."""
    return rows.join(tombstones.withColumnRenamed("paper_id", paper_id), paper_id, "left_anti").select(*rows.columns)


def compact(spark: SparkSession, path: str, tombstones: DataFrame, partition: str, paper_id: str = "id") -> dict:
    """Rewrites the ``partition`` folders of the table at ``path`` that hold buried rows: {"folders", "removed"}.

    A folder that loses all its rows keeps one file without rows. A compaction that dies between two folders is
    run again: what is gone is no longer found, the rest is. One writer at a time.
    """
    checkpoint_root(spark)
    table = spark.read.parquet(path)
    dead = tombstones.withColumnRenamed("paper_id", paper_id)
    touched = (table.join(dead, paper_id, "left_semi").groupBy(partition).agg(F.count(F.lit(1)).alias("n"))
               .select(F.col(partition).alias("_folder"), "n").checkpoint(eager=True))
    seen = touched.agg(F.count(F.lit(1)).alias("folders"), F.coalesce(F.sum("n"), F.lit(0)).alias("removed")).first().asDict()
    if not seen["folders"]:
        return seen
    part = table.join(touched, table[partition].eqNullSafe(touched["_folder"]), "left_semi")
    left = living(part, tombstones, paper_id).checkpoint(eager=True)  # the rewrite must not read what it replaces
    left.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    # A dynamic overwrite leaves folders alone that get no row: these are emptied one by one.
    folders = left.select(F.col(partition).alias("_left")).distinct()
    gone = touched.join(folders, touched["_folder"].eqNullSafe(folders["_left"]), "left_anti").select(F.col("_folder").cast("string"))
    nothing = spark.createDataFrame([], StructType([f for f in table.schema.fields if f.name != partition]))
    for row in gone.toLocalIterator():
        name = "__HIVE_DEFAULT_PARTITION__" if row[0] is None else row[0]
        nothing.write.mode("overwrite").parquet(f"{path}/{partition}={name}")
    return seen
