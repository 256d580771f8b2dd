"""Reloading single batches leaves what a full rebuild would give, and the files of other months alone."""

import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from caselake.plans import reload as R
from caselake.plans import silver as S
from caselake.sources.bronze import COMPLAINT_COLUMNS
from caselake.sources.relations import inline_relation, load_seeds

SPELLINGS = ["Acme Bank, Inc.", "ACME BANK", "Acme Bank LLC", "Beta & Co.", "Beta Corp.", "GAMMA", None]


def batch(rng, name, ids, at, spellings=SPELLINGS):
    rows = []
    for i in ids:
        received = date(2024, 1, 1) + timedelta(days=i * 7 % 360)
        row = {c: None for c in COMPLAINT_COLUMNS} | {
            "complaint_id": rng.choice([str(i), f" {i}", "x12"]) if rng.random() < 0.1 else str(i),
            "date_received": rng.choice([str(received), ""]) if rng.random() < 0.1 else str(received),
            "date_sent_to_company": rng.choice([None, str(received + timedelta(days=rng.randrange(-3, 40)))]),
            "product": rng.choice(["Credit card", "Mortgage"]), "company": rng.choice(spellings), "state": rng.choice(["TX", "??", ""]),
        }
        rows.append((*row.values(), at, "f.csv", name))
    return rows


def bronze_of(spark, *batches):
    schema = ", ".join(f"{c} STRING" for c in COMPLAINT_COLUMNS) + ", _ingested_at TIMESTAMP, _source_file STRING, _batch_id STRING"
    return inline_relation(spark, [r for b in batches for r in b], schema)


def files(path):
    return {f for folder, _, names in os.walk(path) for f in (os.path.relpath(os.path.join(folder, n), path) for n in names) if f.endswith(".parquet")}


def bag(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.fixture(scope="module")
def batches():
    rng = random.Random(11)
    a = batch(rng, "a", range(0, 300), datetime(2024, 12, 1), ["Acme Bank, Inc.", "ACME BANK", "GAMMA", None])
    b = batch(rng, "b", range(200, 230), datetime(2024, 12, 2), ["GAMMA"])
    b_again = batch(rng, "b", range(205, 215), datetime(2024, 12, 3), ["GAMMA"])
    c = batch(rng, "c", range(295, 303), datetime(2024, 12, 4), ["Acme Bank LLC"])  # a second legal form: Acme's rows are renamed
    return a, b, b_again, c


@pytest.mark.parametrize("step", ["replace", "add", "drop", "empty a month"])
def test_reload_equals_a_rebuild(spark, tmp_path, batches, step):
    a, b, b_again, c = batches
    seeds = load_seeds(spark)
    before, after, changed = {
        "replace": ((a, b), (a, b_again), ["b"]),
        "add": ((a, b), (a, b, c), ["c"]),
        "drop": ((a, b, c), (a, c), ["b"]),
        "empty a month": ((a[:3], [(*r[:-1], "z") for r in a[200:204]]), (a[:3],), ["z"]),
    }[step]
    path, lookup_path = str(tmp_path / "silver"), str(tmp_path / "lookup")
    R.write_silver(bronze_of(spark, *before), seeds, path, lookup_path)
    held = files(path)
    bronze = bronze_of(spark, *after)
    months = R.reload_batches(bronze, changed, seeds, path, lookup_path)
    lookup = S.build_company_lookup(bronze, seeds)
    whole = S.build_silver(bronze, lookup, seeds)
    assert bag(spark.read.parquet(path).select(*whole.columns)) == bag(whole)
    assert bag(spark.read.parquet(lookup_path)) == bag(lookup)
    touched = {f"{R.MONTH}={m}" for m in months}
    assert {f for f in files(path) if f.split("/")[0] not in touched} == {f for f in held if f.split("/")[0] not in touched}
    if step == "replace":
        assert 0 < len(months) < 12 and files(path) & held
    if step == "empty a month":
        assert {f.split("/")[0] for f in held} - {f.split("/")[0] for f in files(path)}


def test_summary_takes_back_and_adds(spark, tmp_path):
    rng = random.Random(4)
    rows = lambda name, n: [(name, rng.choice(["p", "q", None]), rng.randrange(4)) for _ in range(n)]
    a, b, b_again, c = rows("a", 200), rows("b", 50) + [("b", "only in b", 1)], rows("b", 20), rows("c", 30)
    table = lambda *parts: inline_relation(spark, [r for p in parts for r in p], "_batch_id STRING, k STRING, m INT")
    path, keys = str(tmp_path), ["k", "m"]
    R.write_summary(table(a, b), keys, path)
    for now, changed in (((a, b_again), ["b"]), ((a, b_again, c), ["c"]), ((a, c), ["b"]), ((a, c), ["b", "a"])):
        other = [r for part in now for r in part if r[0] in changed]  # rows of other batches are not needed
        got = R.refresh_summary(table(other or [("none", None, None)]), changed, keys, path)
        assert bag(got.select(*keys, "n")) == bag(table(*now).groupBy(*keys).agg(F.count("*").alias("n")))


def test_copies_go_before_the_shuffle_whatever_the_number_of_ids(spark):
    rng = random.Random(3)
    rows = S.usable(S.stage(bronze_of(spark, batch(rng, "a", [*range(40), *range(30), *range(9)], datetime(2024, 12, 31)))))
    rows = R.materialise(rows.drop("complaint_id_raw"), "rows")
    ids = R.materialise(rows.filter("complaint_id % 3 = 0").select("complaint_id").distinct(), "ids")
    few, many = R.latest_of(rows, ids), R.latest_of(rows, ids, max_rows=0)
    assert few.columns == many.columns == rows.columns
    assert bag(few) == bag(many) == bag(S.keep_latest(rows).join(ids, "complaint_id", "left_semi").select(*rows.columns))
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("Window [") and "LeftSemi" not in plan
    kept = plan.index("WindowGroupLimit") if "WindowGroupLimit" in plan else plan.index("Window [")
    assert "Join" not in plan[kept:]  # every copy goes before any join
