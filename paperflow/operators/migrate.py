"""Summary-table migration (K8) and the regeneration work list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperflow.operators.quality import null_counts

# Fixed values of the source migration.
RENAMES = {"easy_title": "beginner_title", "layman_summary": "beginner_summary",
           "university_summary": "intermediate_summary"}
ADDED = ("beginner_overview", "intermediate_overview", "beginner_title", "intermediate_title",
         "beginner_summary", "intermediate_summary")
PLACEHOLDERS = {
    "beginner_overview": "Overview pending regeneration",
    "intermediate_overview": "Overview pending regeneration",
    "beginner_title": "Beginner title pending regeneration",
    "intermediate_title": "Intermediate title pending regeneration",
}
OVERVIEW_PLACEHOLDER = "Overview pending regeneration"


def migrate_summaries(df: DataFrame) -> DataFrame:
    """Rename old columns if present, add missing ones, fill NULL/'' in the four
    placeholder columns. The two summary columns are not filled (D18); the Q2 audit
    reports them. Works on old and new shapes alike."""
    for old, new in RENAMES.items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    for c in ADDED:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    for c, ph in PLACEHOLDERS.items():
        df = df.withColumn(c, F.when(F.col(c).isNull() | (F.col(c) == ""), F.lit(ph)).otherwise(F.col(c)))
    return df


def pending_regeneration(df: DataFrame) -> DataFrame:
    """rows whose overview is still the placeholder."""
    return df.filter((F.col("beginner_overview") == OVERVIEW_PLACEHOLDER)
                     | (F.col("intermediate_overview") == OVERVIEW_PLACEHOLDER))


def migrate_table(spark: SparkSession, name: str, location: str, required: tuple[str, ...] = ADDED) -> dict[str, int]:
    """K8 on a stored table: the migrated rows are written to ``location``, checked there (Q2 on ``required``),
    and only then does the table's name stand for them. Returns the null counts of the check by column.

    A failed check raises ``MigrationRefused`` and leaves the old table as it was. The old files stay where they
    are, under no name. Views read the table by name, so they see the new rows at their next use; those that
    hold a DataFrame must be registered again (``catalog.register_views``). One writer at a time; a run that
    dies before the switch leaves the old table, and ``location`` can be written again.
    """
    new, old = f"{name}__new", f"{name}__old"
    spark.sql(f"DROP TABLE IF EXISTS {new}")
    # Read by name: an old-shape or new-shape table alike; the write is complete before anything is switched.
    migrate_summaries(spark.table(name)).write.mode("overwrite").format("parquet").option("path", location).saveAsTable(new)
    nulls = {r["column_name"]: r["n_null"] for r in null_counts(spark.table(new), name, list(required)).collect()}
    if any(nulls.values()):
        spark.sql(f"DROP TABLE {new}")
        raise MigrationRefused(name, nulls)
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE {old}")  # an external table: its files stay
    spark.catalog.refreshTable(name)
    return nulls


class MigrationRefused(ValueError):
    """Required columns hold nulls after the migration; ``nulls`` has the counts."""

    def __init__(self, name: str, nulls: dict[str, int]):
        super().__init__(f"{name}: null in " + ", ".join(f"{c} ({n})" for c, n in nulls.items() if n))
        self.nulls = nulls
