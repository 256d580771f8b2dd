"""Files in and out: raw CSV, header matching, Bronze batches, snapshots, copies, the whole run."""

from __future__ import annotations

from datetime import date, datetime
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.catalog.layers import GOLD_SQL, STAND_IN_DAYS, typed_table
from caselake.catalog.questions import MONTHLY, WITH
from caselake.catalog.registry import query
from caselake.catalog.standin import BATCHES, RAW_SQL, TYPED_SQL, raw_complaints, table, typed_complaints
from caselake.operators.aggregates import count_by_month
from caselake.plans import reload as R
from caselake.plans.analysis import month_over_month
from caselake.plans.medallion import Warehouse, run_layers, tables
from caselake.session import scratch_path
from caselake.sources import bronze as B
from caselake.sources import files as FL
from caselake.sources.relations import calendar, replace_table

# Headers as a publisher writes them; the last two are not expected.
DISPLAY = {
    "date_received": "Date received", "product": "Product", "sub_product": "Sub-product", "issue": "Issue",
    "sub_issue": "Sub-issue", "company": "Company ", "state": "State", "zip_code": "ZIP code",
    "submitted_via": "Submitted via", "date_sent_to_company": "Date sent to company",
    "company_response_to_consumer": "Company response to consumer", "timely_response": "Timely response?",
    "consumer_disputed": "Consumer disputed?", "complaint_id": "Complaint ID",
    "consumer_complaint_narrative": "Consumer complaint narrative",
}
ABSENT = ["company_public_response", "tags", "consumer_consent_provided"]
EXTRA = ["Row colour"]
NOW = datetime(2001, 9, 1)


# In a file an empty text is a missing value, quoted or not.
FILE_RAW_SQL = (
    RAW_SQL.replace("raw AS (", "values_ AS (", 1)
    + ",\nraw AS (SELECT "
    + ", ".join(f"nullif({c}, '') AS {c}" for c in FL.COMPLAINT_TARGETS)
    + ", _ingested_at, _source_file, _batch_id FROM values_)"
)
# the layered run stops at a complaint without a company, so its file has none
NAMED_RAW_SQL = FILE_RAW_SQL.replace(" FROM values_)", " FROM values_ WHERE trim(company) <> '')")


@lru_cache(maxsize=8)
def raw_file(spark: SparkSession, sf: str) -> str:
    """The stand-in complaints as CSV files with publisher's headers."""
    return _written(spark, raw_complaints(spark, sf))


@lru_cache(maxsize=8)
def named_raw_file(spark: SparkSession, sf: str) -> str:
    """The same without rows that name no company."""
    return _written(spark, raw_complaints(spark, sf).filter("trim(company) <> ''"))


def _written(spark: SparkSession, raw: DataFrame) -> str:
    path = scratch_path(spark, "raw_csv")
    columns = [F.col(c).alias(header) for c, header in DISPLAY.items()]
    FL.export_csv(raw.select(*columns, F.lit("blue").alias(EXTRA[0])), path, "gzip")
    return path


@query("a1_raw_csv_scan", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents""")
def _(spark, sf):
    # whole texts with commas, quotes and line ends, written as CSV and read back
    path = scratch_path(spark, "documents_csv")
    FL.export_csv(table(spark, sf, "documents"), path)
    return FL.read_raw_csv(spark, path)


@query("a2_inferred_profile", """
SELECT count(*) AS total_rows, count(DISTINCT o_orderkey) AS distinct_ids, CAST(min(o_orderdate) AS DATE) AS first_date,
  CAST(max(o_orderdate) AS DATE) AS last_date FROM orders""")
def _(spark, sf):
    path = scratch_path(spark, "orders_csv")
    FL.export_csv(table(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate")), path)
    return FL.profile_inferred_csv(spark, path, "o_orderkey", "o_orderdate")


@query("a2_typed_profile", f"""WITH {TYPED_SQL}
SELECT count(*) AS total_rows, count(DISTINCT complaint_id) AS distinct_ids, min(date_received) AS first_date,
  max(date_received) AS last_date FROM complaints""")
def _(spark, sf):
    return FL.profile_line(typed_table(spark, sf), "complaint_id", "date_received")


@query("a3_conform_headers", f"WITH {TYPED_SQL.replace(RAW_SQL, FILE_RAW_SQL)} SELECT * FROM complaints")
def _(spark, sf):
    return FL.conform(FL.read_raw_csv(spark, raw_file(spark, sf))).df


BRONZE_COLUMNS = ", ".join(FL.COMPLAINT_TARGETS)


@query("a4_bronze_columns", f"WITH {FILE_RAW_SQL} SELECT {BRONZE_COLUMNS} FROM raw")
def _(spark, sf):
    return B.to_bronze(FL.read_raw_csv(spark, raw_file(spark, sf))).df


@query("a5_batch_metadata", f"WITH {RAW_SQL} SELECT true AS same_id_per_file, true AS twelve_hex, count(*) AS rows FROM raw")
def _(spark, sf):
    landed = B.land_csv(spark, raw_file(spark, sf), F.lit(NOW))
    per_file = landed.df.groupBy("_source_file").agg(
        F.min("_batch_id").alias("low"), F.max("_batch_id").alias("high"), F.count("*").alias("n")
    )
    return per_file.agg(
        F.bool_and(F.col("low") == F.col("high")).alias("same_id_per_file"),
        F.bool_and(F.col("low").rlike("^[0-9a-f]{12}$")).alias("twelve_hex"),
        F.sum("n").alias("rows"),
    )


def _landed_twice(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    path, log = scratch_path(spark, "bronze"), scratch_path(spark, "ingest_log")
    landed = B.land_csv(spark, raw_file(spark, sf), F.lit(NOW))
    B.write_batch(landed, path, log)
    return B.write_batch(landed, path, log), B.read_log(spark, log)


@query("a6_replaced_batches", f"WITH {FILE_RAW_SQL} SELECT {BRONZE_COLUMNS} FROM raw")
def _(spark, sf):
    # the same files land twice: nothing is doubled
    return _landed_twice(spark, sf)[0].select(*FL.COMPLAINT_TARGETS)


@query("a6_ingest_log", f"""WITH {RAW_SQL}
SELECT count(*) AS row_count, '{", ".join(ABSENT)}' AS missing_columns, '{", ".join(EXTRA)}' AS extra_columns FROM raw""")
def _(spark, sf):
    log = _landed_twice(spark, sf)[1]
    return log.groupBy("missing_columns", "extra_columns").agg(F.sum("row_count").alias("row_count"))


@query("a7_snapshot", f"WITH {FILE_RAW_SQL} SELECT {BRONZE_COLUMNS} FROM raw")
def _(spark, sf):
    path = scratch_path(spark, "snapshots")
    B.write_snapshot(B.land_csv(spark, raw_file(spark, sf), F.lit(NOW)).df, path)
    return spark.read.parquet(path).select(*FL.COMPLAINT_TARGETS)


@query("a10_days_without_orders", """
SELECT d FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
ANTI JOIN orders ON CAST(o_orderdate AS DATE) = d""")
def _(spark, sf):
    days = calendar(spark, date(1995, 1, 1), date(2002, 1, 1))
    ordered = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    return days.join(ordered, "d", "left_anti")


@query("a13_summary_table", WITH + MONTHLY + """,
s AS (SELECT *, lag(n) OVER (PARTITION BY product ORDER BY month) AS prev_n FROM m)
SELECT product, month, n, prev_n, n - prev_n AS mom_change, round(100.0 * (n - prev_n) / nullif(prev_n, 0), 1) AS mom_pct FROM s""")
def _(spark, sf):
    monthly = count_by_month(typed_complaints(spark, sf), "product", "date_received")
    return month_over_month(replace_table(monthly, scratch_path(spark, "monthly_per_product")))


@query("a13_refreshed_summary", f"""WITH {RAW_SQL}
SELECT product, state, count(*) AS n FROM raw GROUP BY ALL""")
def _(spark, sf):
    # one batch is replaced, one dropped: their old counts are taken back, the new ones added
    rows, path = raw_complaints(spark, sf), scratch_path(spark, "state_summary")
    before = rows.filter((F.col("_batch_id") != "batch-b") | F.col("state").isNull())
    dropped = rows.filter("state IS NOT NULL").withColumn("_batch_id", F.lit("batch-x")).withColumn("product", F.lit("only there"))
    R.write_summary(before.unionByName(dropped), ["product", "state"], path)
    return R.refresh_summary(rows, ["batch-b", "batch-x"], ["product", "state"], path)


@query("a14_csv_export", "SELECT COLUMNS(*)::VARCHAR FROM part")
def _(spark, sf):
    path = scratch_path(spark, "parts_csv")
    FL.export_csv(table(spark, sf, "part"), path)
    return FL.read_raw_csv(spark, path)


@query("a15_verified_copy", "SELECT * FROM customer")
def _(spark, sf):
    return FL.copy_verified(table(spark, sf, "customer"), scratch_path(spark, "customer_copy"))


_INGESTED = f"""CASE WHEN l_linenumber <= 4 THEN TIMESTAMP '{BATCHES["batch-a"]}' ELSE TIMESTAMP '{BATCHES["batch-b"]}' END"""


@query("a16_layered_run", GOLD_SQL.replace(RAW_SQL, NAMED_RAW_SQL).replace(_INGESTED, f"TIMESTAMP '{NOW}'") + " SELECT * FROM scorecard")
def _(spark, sf):
    warehouse = Warehouse(scratch_path(spark, "warehouse"))
    days = {"first_day": STAND_IN_DAYS[0], "calendar": STAND_IN_DAYS}
    run_layers(spark, warehouse, named_raw_file(spark, sf), snapshot=True, now=NOW, **days)
    run_layers(spark, warehouse, start="gold", now=NOW, **days)
    return tables(spark, warehouse)["company_scorecard"]


@query("a16_typed_reload", f"WITH {TYPED_SQL} SELECT count(*) AS n, count(complaint_id) AS ids FROM complaints")
def _(spark, sf):
    return typed_table(spark, sf).agg(F.count("*").alias("n"), F.count("complaint_id").alias("ids"))
