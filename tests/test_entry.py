"""Driver contract: entry smoke, and every query against its DuckDB oracle."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

from conftest import SF_SMALL  # noqa: E402


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["year", "participations", "medals", "gold_medals", "silver_medals",
                          "bronze_medals", "medal_rate"]


def test_every_query_has_an_oracle():
    """All but corpus queries that SQL cannot express (tested against brute force on their own)."""
    assert set(oracle_sql()) <= set(queries())
    without = set(queries()) - set(oracle_sql())
    assert all(name == "pipeline" or name.startswith("op") for name in without)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    o_rows = res.fetchall()
    assert rows_of(df.columns, s_rows) == rows_of(res.columns, o_rows)
