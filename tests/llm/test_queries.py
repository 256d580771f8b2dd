"""The registered queries next to their DuckDB texts, and the pipeline from end to end, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from caselake.llm.queries import ORACLES, QUERIES
from tools.check import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_all_are_registered():
    names = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLES))
def test_as_duckdb_says(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rel = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == docs.columns
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    kept = {r.doc_id for r in out.select("doc_id").collect()}
    assert kept and kept < ids
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert not [i for i in kept if labels.get(i) == 0 and i in ids][5:]
