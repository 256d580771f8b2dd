"""Every registered query next to its DuckDB text, on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as entry  # noqa: E402
from tools.check import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
OWN = [name for name in QUERIES if not name.startswith("op") and name != "pipeline"]  # tests/llm has the others


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_a_text():
    assert not set(OWN) - set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", OWN)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if name in ORACLES:
        rel = duck.sql(ORACLES[name])
        assert sorted(df.columns) == sorted(rel.columns)
        assert rows_of(df.columns, got) == rows_of(rel.columns, rel.fetchall())
