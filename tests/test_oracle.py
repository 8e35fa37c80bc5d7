"""Every registered query against its DuckDB SQL on the smallest tables (the driver
runs the same comparison at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from paperflow.sources.tables import TABLES
from tools.check_oracle import digest

SQL = E.oracle_sql()
KEYS = sorted(E.queries())
REFERENCE = sorted(E.REGISTRY)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def test_every_key_has_oracle():
    missing = [k for k in REFERENCE if k not in SQL]
    assert missing == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "arxiv_id" and len(df.columns) == 15
    assert df.count() >= 0


@pytest.mark.parametrize("key", [k for k in KEYS if k in SQL])
def test_query_matches_oracle(spark, sf, duck, key):
    got = digest(E.queries()[key](spark, sf).toPandas())
    want = digest(duck.execute(SQL[key]).df())
    assert got[0] == want[0], "columns"
    assert got[1] == want[1], "row count"
    assert got[2] == want[2], "values"
