import csv
import glob
import os
import random
from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from caselake.catalog.standin import raw_complaints
from caselake.operators import checks as Q
from caselake.operators.checks import GateError
from caselake.plans import medallion as M
from caselake.plans.medallion import Warehouse, run_layers, tables
from caselake.session import TASK_BYTES, TASK_SIZES, configure, materialise, scratch_path, scratch_tables, side_by_side
from caselake.sources import bronze as B
from caselake.sources import files as FL
from caselake.sources import relations as R
from caselake.sources.relations import inline_relation

HEADER = [
    "Date received", "Product", "Sub-product", "Issue", "Sub-issue", "Company", "State", "ZIP code", "Submitted via",
    "Date sent to company", "Company response to consumer", "Timely response?", "Complaint ID", "Row colour",
]


def row(cid, day="2025-01-02", sent="2025-01-03", company="ACME, INC.", product="Mortgage", state="CA", **more):
    base = [day, product, "Fixed", "Fees", "", company, state, "1234", "Web", sent, "In progress", "Yes", cid, "red"]
    for name, value in more.items():
        base[HEADER.index(name.replace("_", " "))] = value
    return base


ROWS = [
    row("1"),
    row("x12"),
    row(""),
    row("2", day=""),
    row("3", sent="2025-01-05"), row("3", sent="2025-01-09", company="Acme Inc."), row("3", sent=""),
    row("4", day="2025-02-01", sent="2025-01-20"),
    row("5", day="2030-01-01", sent=""),
    row("6", company=" ACME INC"),
    row("7", state="ZZ"),
    row("8", state="United States Minor Outlying Islands"),
    row("9", product="Crypto"),
    row("10", Issue="Cont'd attempts collect debt not owed"),
    row("11", company='The "Quoted", Co\nsecond line'),
]


def write_csv(path, rows, header=HEADER):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([header, *rows])
    return str(path)


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "4000", "spark.sql.files.openCostInBytes": "100"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_quoted_line_ends_across_splits(spark, tmp_path, small_splits):
    random.seed(1)
    texts = ["a", "x,y", 'say "hi"', "line\nbreak", 'two\n\n"q"\nlines', "", "tail\r\nwin", "\n" * 3000]
    want = []
    for n in (1, 2):
        rows = [[str(i), random.choice(texts[:-1])] for i in range(2000)] + [["big", texts[-1]]]
        write_csv(tmp_path / f"f{n}.csv", rows, ["Complaint ID", "Text?"])
        want += [tuple(r) for r in rows]
    df = FL.read_raw_csv(spark, str(tmp_path))
    assert df.columns == ["Complaint ID", "Text?"]
    got = [tuple(v or "" for v in r) for r in df.collect()]
    assert sorted(got) == sorted(want)


def test_single_line_files_use_the_plain_reader(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", [["1", 'a "b", c']], ["Complaint ID", "t"])
    assert not FL.has_multiline_records(spark, path)
    assert FL.read_raw_csv(spark, path).collect()[0]["t"] == 'a "b", c'


def parsed(spark, path, **options):
    df = spark.read.csv(path, header=True, quote='"', escape='"', **options)
    return sorted(tuple(v or "" for v in r) for r in df.collect())


def test_stray_quotes_lose_nothing(spark, tmp_path, small_splits):
    lines = [f'{i},plain {i}' for i in range(300)]
    lines[40], lines[41], lines[200] = '40,5" pipe', '41,6 ft" and 7"', '200,a "b" c'
    lines[100] = '100,"two\nlines, one "" quote"'
    (tmp_path / "s.csv").write_text("id,t\n" + "\n".join(lines) + "\n")
    df = FL.read_raw_csv(spark, str(tmp_path / "s.csv"))
    assert df.count() == 300
    assert sorted(tuple(v or "" for v in r) for r in df.collect()) == parsed(spark, str(tmp_path / "s.csv"), multiLine=True)


@pytest.mark.parametrize("seed", range(6))
def test_random_quotes_as_spark_reads_them(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    fields = ["a", "", 'b"c', 'd" "', '"x,y"', '"q""r"', '"line\nend"', '"\n\n"', '"""\n"""', "e f"]
    body = "".join(f"{i},{rng.choice(fields)},{rng.choice(fields)},z\n" for i in range(400))
    (tmp_path / "r.csv").write_text("id,t,u,v\n" + body)
    got = FL.read_raw_csv(spark, str(tmp_path / "r.csv"), multi_line=True)
    assert sorted(tuple(v or "" for v in r) for r in got.collect()) == parsed(spark, str(tmp_path / "r.csv"), multiLine=True)


def test_a_field_that_never_closes_is_reported(spark, tmp_path):
    (tmp_path / "u.csv").write_text('id,t\n1,"open\n2,b\n')
    with pytest.raises(ValueError, match="u.csv"):
        FL.read_raw_csv(spark, str(tmp_path / "u.csv")).collect()


@pytest.mark.parametrize("text", ["x", "x\ny"])
def test_other_headers_are_reported(spark, tmp_path, text):
    write_csv(tmp_path / "a.csv", [["1", text]], ["id", "company"])
    write_csv(tmp_path / "b.csv", [[text, "2"]], ["company", "id"])
    with pytest.raises(Exception, match="[ab].csv"):
        FL.read_raw_csv(spark, str(tmp_path)).collect()


def test_ambiguous_headers(spark):
    df = inline_relation(spark, [("7", "8", "2025-01-01", "p", "c")], "`Complaint ID` STRING, `complaint-id` STRING, `Date-Received` STRING, product STRING, Company STRING")
    with pytest.raises(ValueError, match="ambiguous"):
        FL.conform(df)


def test_conform(spark):
    df = inline_relation(spark, [("7", "2025-01-01", "p", "c")], "`COMPLAINT id` STRING, `Date-Received` STRING, product STRING, Company STRING")
    conformed = FL.conform(df)
    assert dict(conformed.df.dtypes)["complaint_id"] == "bigint"
    assert dict(conformed.df.dtypes)["date_sent_to_company"] == "date"
    assert "tags" in conformed.missing
    with pytest.raises(ValueError, match="company"):
        FL.conform(df.drop("Company"))


def test_bronze_columns_and_batches(spark, tmp_path):
    path = write_csv(tmp_path / "c.csv", ROWS)
    landed = B.land_csv(spark, path, F.lit(datetime(2025, 3, 1)))
    assert landed.extra == ["Row colour"]
    assert landed.missing == ["consumer_complaint_narrative", "company_public_response", "tags", "consumer_consent_provided", "consumer_disputed"]
    assert all(t in ("string", "timestamp") for _, t in landed.df.dtypes)
    bronze, log = str(tmp_path / "bronze"), str(tmp_path / "log")
    first = sorted(map(str, B.write_batch(landed, bronze, log).collect()))
    assert sorted(map(str, B.write_batch(landed, bronze, log).collect())) == first
    assert len(first) == len(ROWS)
    other = write_csv(tmp_path / "d.csv", ROWS[:2])
    assert B.write_batch(B.land_csv(spark, other), bronze, log).count() == len(ROWS) + 2
    assert sorted(r["row_count"] for r in B.read_log(spark, log).collect()) == [2, len(ROWS)]
    assert B.write_batch(B.land_csv(spark, other), bronze, log, replace_all=True).count() == 2
    assert B.read_log(spark, log).count() == 2


def test_copy_is_verified(spark, tmp_path):
    df = spark.range(10)
    assert FL.copy_verified(df, str(tmp_path / "copy")).count() == 10
    with pytest.raises(ValueError):
        FL.copy_verified(df, str(tmp_path / "copy2"), expected=11)


def test_layers(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path / "lake"))
    path = write_csv(tmp_path / "c.csv", [r for r in ROWS if r[12] != "5"])
    now = datetime(2025, 3, 1)
    run = run_layers(spark, warehouse, path, snapshot=True, now=now)
    stored = tables(spark, warehouse)
    silver = {r["complaint_id"]: r for r in stored["silver"].collect()}
    assert sorted(silver) == [1, 3, 4, 6, 7, 8, 9, 10, 11]
    assert silver[3]["company_raw"] == "Acme Inc." and silver[3]["days_to_send"] == 7
    assert silver[1]["company"] == silver[3]["company"] == silver[6]["company"] == "ACME"
    assert silver[4]["dq_sent_before_received"] and silver[4]["days_to_send"] == -12
    assert silver[7]["region"] == "Invalid code" and silver[7]["dq_invalid_state"]
    assert silver[8]["state"] == "UM" and silver[9]["product_group"] == "Crypto"
    assert silver[10]["issue"] == "Attempts to collect debt not owed"
    reasons = sorted(r["reject_reason"] for r in stored["rejects"].collect())
    assert reasons == ["invalid complaint_id", "invalid complaint_id", "invalid date_received"]
    assert "## Completeness (Silver)" in run.report and "FAIL" in run.report  # a warning, not an error
    again = run_layers(spark, warehouse, start="silver", now=now)
    assert {r["complaint_id"]: r for r in tables(spark, warehouse)["silver"].collect()} == silver
    assert "bronze" not in again.timings
    assert stored["fct_complaints"].count() == len(silver) and stored["dim_company"].filter("company_key = -1").count() == 1
    assert spark.read.parquet(warehouse.path("snapshots")).count() == stored["bronze"].count()


def readable(spark, warehouse):
    return {name: sorted(map(str, df.collect())) for name, df in tables(spark, warehouse).items()}


@pytest.mark.parametrize("bad, message", [(row("20", company=""), "company is set"), (row("21", day="2031-01-01"), "in range")])
def test_a_failing_silver_leaves_the_old_tables(spark, tmp_path, bad, message):
    warehouse, now = Warehouse(str(tmp_path / "lake")), datetime(2025, 3, 1)
    good = [r for r in ROWS if r[12] != "5"]
    run_layers(spark, warehouse, write_csv(tmp_path / "c.csv", good), now=now)
    before = readable(spark, warehouse)
    with pytest.raises(GateError, match=message):
        run_layers(spark, warehouse, write_csv(tmp_path / "d.csv", [*good, bad]), now=now)
    assert readable(spark, warehouse) == before


def test_failing_seeds_and_marts(spark, tmp_path):
    warehouse, now = Warehouse(str(tmp_path / "lake")), datetime(2025, 3, 1)
    path = write_csv(tmp_path / "c.csv", [r for r in ROWS if r[12] != "5"])
    run_layers(spark, warehouse, path, now=now)
    before = readable(spark, warehouse)
    with pytest.raises(GateError, match="is in dim_date"):  # a calendar without the facts' days
        run_layers(spark, warehouse, start="gold", now=now, calendar=(date(2020, 1, 1), date(2021, 1, 1)))
    assert readable(spark, warehouse) == before
    seeds = tmp_path / "seeds"
    seeds.mkdir()
    for name, columns in R.SEEDS.items():
        rows = R.seed_rows(name)
        write_csv(seeds / f"{name}.csv", rows + rows[:1] * (name == "product_map"), columns)
    with pytest.raises(GateError, match="product_map.product is unique"):
        run_layers(spark, warehouse, path, now=now, seed_folder=str(seeds))


@pytest.mark.parametrize("layer", ["bronze", "silver", "gold", "mart"])
def test_readers_see_one_version(spark, tmp_path, monkeypatch, layer):
    warehouse, now = Warehouse(str(tmp_path / "lake")), datetime(2025, 3, 1)
    good = [r for r in ROWS if r[12] != "5"]
    run_layers(spark, warehouse, write_csv(tmp_path / "c.csv", good), now=now)
    before = readable(spark, warehouse)
    checks = f"{layer}_checks"
    real = getattr(M, checks)
    monkeypatch.setattr(M, checks, lambda *a: [*real(*a), Q.RowCheck("never right", spark.range(1), F.lit(True))])
    new = write_csv(tmp_path / "d.csv", [*good, row("20")])
    with pytest.raises(GateError, match="never right"):
        run_layers(spark, warehouse, new, now=now, keep_history=True)
    assert readable(spark, warehouse) == before
    monkeypatch.setattr(M, checks, real)
    if layer == "bronze":
        return
    # a later run goes on from the layer that passed last, and publishes all of them together
    run_layers(spark, warehouse, start={"silver": "silver", "gold": "gold", "mart": "gold"}[layer], now=now)
    stored = tables(spark, warehouse)
    assert stored["fct_complaints"].count() == len(before["fct_complaints"]) + 1 == stored["silver"].count()
    assert stored["bronze"].count() == 2 * len(good) + 1 and stored["log"].count() == 2  # both files


def test_history_replaces_a_batch_that_comes_again(spark, tmp_path):
    warehouse, now = Warehouse(str(tmp_path / "lake")), datetime(2025, 3, 1)
    good = [r for r in ROWS if r[12] != "5"]
    first, second = write_csv(tmp_path / "c.csv", good), write_csv(tmp_path / "d.csv", [row("20")])
    for path in (first, second, first):
        run_layers(spark, warehouse, path, now=now, keep_history=True)
    stored = tables(spark, warehouse)
    assert stored["bronze"].count() == len(good) + 1
    assert sorted(r["row_count"] for r in stored["log"].collect()) == [1, len(good)]
    run_layers(spark, warehouse, second, now=now)  # replaces everything, but for the log
    stored = tables(spark, warehouse)
    assert stored["bronze"].count() == 1 and stored["log"].count() == 2


def test_intermediate_tables_are_removed(spark):
    with scratch_tables(spark):
        kept = scratch_path(spark, "x")
        made = side_by_side({n: lambda n=n: materialise(spark.range(3), n) for n in "ab"})
        assert all(df.count() == 3 for df in made.values())
        files = [f for df in made.values() for f in df.inputFiles()]
    root = kept.rsplit("/", 2)[0]
    assert all(root in f for f in files) and not os.path.exists(root) and root not in scratch_path(spark, "y")


def test_layout_skips_files_and_row_groups(spark, tmp_path):
    rows = [(i, date(2020, 1, 1) + timedelta(days=i * 7919 % 1500), f"c{i % 50}") for i in range(20_000)]
    df = inline_relation(spark, rows, "complaint_id LONG, date_received DATE, company STRING").repartition(8)
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as if the table were large
    written = R.write_for_lookups(df, path, "date_received", ["company"], "complaint_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert written.count() == 20_000
    groups = [pq.ParquetFile(f).metadata.row_group(0).column(1).statistics for f in glob.glob(f"{path}/*.parquet")]
    day = date(2021, 6, 1)
    assert len(groups) == 4 and sum(g.min <= day <= g.max for g in groups) == 1
    blooms = [pq.ParquetFile(f).metadata.row_group(0).column(0) for f in glob.glob(f"{path}/*.parquet")]
    assert all(b.path_in_schema == "complaint_id" for b in blooms)


def test_gate_stops_before_gold_is_trusted(spark, tmp_path):
    # one complaint is dated in the future
    warehouse = Warehouse(str(tmp_path / "lake"))
    path = write_csv(tmp_path / "c.csv", ROWS)
    with pytest.raises(GateError, match="in range"):
        run_layers(spark, warehouse, path, now=datetime(2025, 3, 1))


def test_the_raw_file_is_written_compressed_in_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(i, f'a "{i}", b') for i in range(25)], "n int, t string").coalesce(1)
    monkeypatch.setattr(FL, "COMPRESSED_ROWS", 10)
    FL.export_csv(rows, str(tmp_path / "csv"), "gzip")
    assert len(list((tmp_path / "csv").glob("*.csv.gz"))) == 3
    assert sorted((int(r["n"]), r["t"]) for r in FL.read_raw_csv(spark, str(tmp_path / "csv")).collect()) == [(i, f'a "{i}", b') for i in range(25)]


def test_the_stand_in_shuffles_no_text_of_a_part_after_its_join(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of any size
    try:
        plan = raw_complaints(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.split("\n")
    last = max(i for i, line in enumerate(lines) if "p_partkey" in line and "SortMergeJoin" in line)
    assert not [line for line in lines[:last] if "Exchange" in line]


def test_a_task_reads_at_most_16_mb_unless_the_session_has_less(spark):
    before = {key: spark.conf.get(key) for key in TASK_SIZES}
    try:
        for given, kept in (("134217728b", str(TASK_BYTES)), ("64MB", str(TASK_BYTES)), ("16k", "16k"), ("1m", "1m")):
            for key in TASK_SIZES:
                spark.conf.set(key, given)
            configure(spark)
            assert [spark.conf.get(key) for key in TASK_SIZES] == [kept, kept]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _open_at_end(line):
    """Field by field: what starts with a quote is closed by the next single one."""
    at = 0
    while True:
        if line[at : at + 1] == '"':
            at += 1
            while line[at : at + 1] != '"' or line[at : at + 2] == '""':
                if at >= len(line):
                    return True
                at += 2 if line[at] == '"' else 1
        at = line.find(",", at)
        if at < 0:
            return False
        at += 1


def test_open_quotes_are_seen_in_one_pass_of_the_line(spark):
    rng = random.Random(3)
    lines = ["".join(rng.choice('"",ab\r ') for _ in range(rng.randrange(14))) for _ in range(3000)] + ['"x",' * 5000 + '"y']
    look = FL._open_after(F.col("value"))
    assert "regexp_replace" not in str(look)
    got = spark.createDataFrame([(v,) for v in lines], "value STRING").select("value", look.alias("open")).collect()
    assert [r["open"] for r in got] == [_open_at_end(r["value"]) for r in got]
