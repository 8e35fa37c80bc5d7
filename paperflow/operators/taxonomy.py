"""Category taxonomy: load (S4), translate code arrays (J1), select rows missing
names (F8/F14) and backfill them (J6/K2).

Translation keeps each array element in place. It depends only on the code array, so the
distinct arrays are exploded with positions, joined with the taxonomy, regrouped and joined
back; AQE broadcasts a side only if its measured size allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def taxonomy_dim(taxonomy: DataFrame) -> DataFrame:
    """One name per code. The source keeps whichever row it read last; we pick
    ``min(name)`` so the result is deterministic (D7) and report the duplicates. A NULL
    code names nothing."""
    return taxonomy.filter(F.col("category_code").isNotNull()).groupBy("category_code").agg(
        F.min("category_name").alias("category_name"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def translate_categories(papers: DataFrame, taxonomy: DataFrame, codes_col: str = "categories",
                         out_col: str = "translated") -> DataFrame:
    """Adds ``out_col``: a matched code becomes its name (a NULL name stays NULL, D8), an
    unmatched code stays itself; order and duplicates are kept."""
    dim = taxonomy_dim(taxonomy)
    # The translation depends only on the code array, so translate the
    # distinct arrays (partially aggregated: a popular combination is combined map-side),
    # then join back on the array value. Each regroup holds one array's few codes; the
    # join back is planned by AQE (broadcast when the mapping is small, skewed
    # partitions split otherwise). No row key is needed, so duplicate rows are safe.
    arrays = papers.select(F.col(codes_col).alias("_codes")).filter(F.col("_codes").isNotNull()).distinct()
    ex = arrays.select("_codes", F.posexplode("_codes").alias("pos", "code"))
    named = dim.select(F.col("category_code").alias("code"), "category_name", F.lit(True).alias("hit"))
    j = ex.join(named, "code", "left")
    name = F.when(F.col("hit"), F.col("category_name")).otherwise(F.col("code"))
    mapping = j.groupBy("_codes").agg(F.sort_array(F.collect_list(F.struct("pos", name.alias("v")))).alias("pairs"))
    mapping = mapping.select("_codes", F.transform("pairs", lambda p: p["v"]).alias(out_col))
    out = papers.join(mapping, papers[codes_col] == mapping["_codes"], "left").drop("_codes")
    empty = F.when(F.col(codes_col).isNotNull() & (F.size(codes_col) == 0), F.array().cast("array<string>"))
    return out.withColumn(out_col, F.coalesce(F.col(out_col), empty))


def needs_names(papers: DataFrame, include_untranslated: bool = False) -> DataFrame:
    """F8: rows whose names are NULL or empty. ``include_untranslated`` also selects rows
    whose names equal their codes - rows ingested while the taxonomy was empty, which
    the plain rule never repairs (D4)."""
    n = F.col("categories_name")
    cond = n.isNull() | (F.size(n) == 0)
    if include_untranslated:
        cond = cond | (n == F.col("categories"))
    return papers.filter(cond)


def backfill_names(papers: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Fill names on F8 rows that have codes (F14), leave all others as they are.
    Returns the whole table plus ``names_filled`` (count it with ``count_if``)."""
    n = F.col("categories_name")
    fill = (n.isNull() | (F.size(n) == 0)) & (F.size(F.coalesce(F.col("categories"), F.array())) > 0)
    t = translate_categories(papers.withColumn("names_filled", fill), taxonomy, out_col="_names")
    return (t.withColumn("categories_name", F.when(F.col("names_filled"), F.col("_names")).otherwise(n))
            .drop("_names"))
