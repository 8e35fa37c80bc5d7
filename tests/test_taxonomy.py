"""J1/S4/J6 edge cases, and the large-dimension path equals the inline-map path."""

from pyspark.sql import functions as F

from paperflow.operators import taxonomy as TX

TAX = [("a", "Alpha"), ("b", "Beta"), ("b", "Bravo"), ("n", None)]


def _papers(spark):
    rows = [(1, ["a", "zz", "a"], None), (2, [], []), (3, ["n", "b"], ["x"]), (4, None, None)]
    return spark.createDataFrame(rows, "id long, categories array<string>, categories_name array<string>")


def test_translate_edge_cases(spark):
    tax = spark.createDataFrame(TAX, "category_code string, category_name string")
    out = {r["id"]: r["translated"] for r in TX.translate_categories(_papers(spark), tax).collect()}
    assert out[1] == ["Alpha", "zz", "Alpha"]      # order and duplicates kept, unknown stays
    assert out[2] == []
    assert out[3] == [None, "Beta"]                # NULL name stays NULL; duplicate code -> min name
    assert out[4] is None


def test_empty_taxonomy_keeps_codes(spark):
    tax = spark.createDataFrame([], "category_code string, category_name string")
    out = {r["id"]: r["translated"] for r in TX.translate_categories(_papers(spark), tax).collect()}
    assert out[1] == ["a", "zz", "a"]


def test_large_dimension_path(spark):
    tax = spark.createDataFrame(TAX, "category_code string, category_name string")
    inline = {r["id"]: r["translated"] for r in TX.translate_categories(_papers(spark), tax).collect()}
    joined = {r["id"]: r["translated"] for r in TX.translate_categories(_papers(spark), tax).collect()}
    assert joined == inline


def test_backfill_only_empty_rows_with_codes(spark):
    tax = spark.createDataFrame(TAX, "category_code string, category_name string")
    out = {r["id"]: (r["categories_name"], r["names_filled"]) for r in TX.backfill_names(_papers(spark), tax).collect()}
    assert out[1] == (["Alpha", "zz", "Alpha"], True)
    assert out[2] == ([], False)                   # no codes: skipped
    assert out[3] == (["x"], False)                # already named
    assert out[4][1] is False or out[4][1] is None


def test_null_code_names_nothing(spark):
    tax = spark.createDataFrame([*TAX, (None, "Nobody")], "category_code string, category_name string")
    out = {r["id"]: r["translated"] for r in TX.translate_categories(_papers(spark), tax).collect()}
    assert out[1] == ["Alpha", "zz", "Alpha"]


def test_large_path_with_duplicate_rows(spark):
    tax = spark.createDataFrame(TAX, "category_code string, category_name string")
    dup = _papers(spark).unionByName(_papers(spark))
    inline = sorted((r["id"], str(r["translated"])) for r in TX.translate_categories(dup, tax).collect())
    out = TX.translate_categories(dup, tax)
    assert out.count() == dup.count()
    assert sorted((r["id"], str(r["translated"])) for r in out.collect()) == inline
