"""Dimensions, facts, star questions and star checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselake.catalog.layers import (
    SEEDS_SQL, WITH_SILVER, lookup_table, mart_tables, star_tables, text_sql, typed_table,
)
from caselake.catalog.registry import query
from caselake.catalog.standin import TYPED_SQL, sql_text
from caselake.functions.columns import PRODUCT_GROUP_RULES
from caselake.plans import star as ST


def _group_sql(column: str) -> str:
    branches = []
    for group, texts in PRODUCT_GROUP_RULES:
        tests = [f"{column} ILIKE {sql_text(t)}" if t.endswith("%") else f"{column} = {sql_text(t)}" for t in texts]
        branches.append(f"WHEN {' OR '.join(tests)} THEN {sql_text(group)}")
    return f"CASE {' '.join(branches)} ELSE {column} END"


# the calendar of the stand-in years (STAND_IN_DAYS)
DATES_SQL = """dates AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(year(d) AS SMALLINT) AS year,
    CAST(quarter(d) AS SMALLINT) AS quarter, CAST(month(d) AS SMALLINT) AS month, monthname(d) AS month_name,
    strftime(d, '%Y-%m') AS year_month, CAST(isodow(d) AS SMALLINT) AS day_of_week, dayname(d) AS day_name,
    isodow(d) >= 6 AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(DATE '1994-01-01', DATE '2003-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
  UNION ALL SELECT -1, NULL, NULL, NULL, NULL, 'Unknown', 'Unknown', NULL, 'Unknown', NULL)"""
FLAGS = ", ".join(ST.RESPONSE_FLAGS)
STAR_SQL = f"""WITH {TYPED_SQL}, {SEEDS_SQL},
v AS (SELECT complaint_id, date_received, date_sent_to_company AS date_sent,
  {text_sql('product', 'Unknown')} AS product, {text_sql('sub_product', 'N/A')} AS sub_product,
  {text_sql('issue', 'Unknown')} AS issue, {text_sql('sub_issue', 'N/A')} AS sub_issue,
  {text_sql('company')} AS company, upper({text_sql('state')}) AS state,
  {text_sql('submitted_via', 'Unknown')} AS submitted_via,
  {text_sql('company_response_to_consumer', 'Unknown')} AS company_response,
  {text_sql('timely_response', 'Unknown')} AS timely_response,
  {text_sql('consumer_disputed', 'Not collected')} AS consumer_disputed,
  consumer_complaint_narrative IS NOT NULL AS has_narrative FROM complaints WHERE complaint_id IS NOT NULL),
{DATES_SQL},
companies AS (SELECT CAST(row_number() OVER (ORDER BY company) AS INTEGER) AS company_key, company AS company_name_raw,
    upper(company) AS company_name_clean FROM (SELECT DISTINCT company FROM v) WHERE company IS NOT NULL
  UNION ALL SELECT -1, 'Unknown', 'UNKNOWN'),
products AS (SELECT CAST(row_number() OVER (ORDER BY product, sub_product) AS INTEGER) AS product_key, product, sub_product,
    {_group_sql('product')} AS product_group FROM (SELECT DISTINCT product, sub_product FROM v)),
issues AS (SELECT CAST(row_number() OVER (ORDER BY issue, sub_issue) AS INTEGER) AS issue_key, issue, sub_issue
  FROM (SELECT DISTINCT issue, sub_issue FROM v)),
states AS (SELECT CAST(row_number() OVER (ORDER BY state) AS INTEGER) AS state_key, state AS state_code,
    ifnull(state_name, 'Other code: ' || state) AS state_name, ifnull(region, 'Unknown') AS region
  FROM (SELECT DISTINCT state FROM v WHERE state IS NOT NULL) LEFT JOIN state_ref ON state_code = state
  UNION ALL SELECT -1, 'NA', 'Unknown', 'Unknown'),
responses AS (SELECT CAST(row_number() OVER (ORDER BY {FLAGS}) AS INTEGER) AS response_key, {FLAGS}
  FROM (SELECT DISTINCT {FLAGS} FROM v)),
fact AS (SELECT complaint_id, ifnull(CAST(strftime(date_received, '%Y%m%d') AS INTEGER), -1) AS date_received_key,
    ifnull(CAST(strftime(date_sent, '%Y%m%d') AS INTEGER), -1) AS date_sent_key,
    ifnull(company_key, -1) AS company_key, product_key, issue_key, ifnull(state_key, -1) AS state_key, response_key,
    1::SMALLINT AS complaint_count, CAST(date_diff('day', date_received, date_sent) AS INTEGER) AS days_to_send,
    CAST(map {{'Yes': 1, 'No': 0}}[timely_response] AS SMALLINT) AS is_timely,
    CAST(map {{'Yes': 1, 'No': 0}}[consumer_disputed] AS SMALLINT) AS is_disputed,
    CAST(has_narrative AS SMALLINT) AS has_narrative
  FROM v JOIN products USING (product, sub_product) JOIN issues USING (issue, sub_issue) JOIN responses USING ({FLAGS})
    LEFT JOIN companies ON company_name_raw = company AND company_key > 0
    LEFT JOIN states ON state_code = state AND state_key > 0)"""

DIMENSIONS = {
    "kd2_dim_company_raw": ("dim_company", "companies"),
    "kd3_dim_product": ("dim_product", "products"),
    "kd4_dim_issue": ("dim_issue", "issues"),
    "kd5_dim_state_seen": ("dim_state", "states"),
    "kd6_dim_response": ("dim_response", "responses"),
    "kd7_fact_complaints": ("fact_complaints", "fact"),
}


def _register(name: str, table: str, sql_name: str) -> None:
    query(name, f"{STAR_SQL} SELECT * FROM {sql_name}")(lambda spark, sf: star_tables(spark, sf)[table])


for _name, (_table, _sql) in DIMENSIONS.items():
    _register(_name, _table, _sql)


@query("kd1_dim_date", f"""{STAR_SQL}
SELECT d.*, count(date_received_key) AS complaints FROM dates d LEFT JOIN fact ON date_received_key = date_key GROUP BY ALL""")
def _(spark, sf):
    star = star_tables(spark, sf)
    per_day = star["fact_complaints"].groupBy(F.col("date_received_key").alias("date_key")).agg(
        F.count("*").alias("complaints")
    )
    days = star["dim_date"].join(per_day, "date_key", "left")
    return days.withColumn("complaints", F.coalesce("complaints", F.lit(0)))


@query("kd2_dim_company_marts", f"""{WITH_SILVER}
SELECT CAST(row_number() OVER (ORDER BY company) AS INTEGER) AS company_key, company AS company_name,
  count(*) AS raw_name_variants, string_agg(DISTINCT legal_form, ', ' ORDER BY legal_form) FILTER (legal_form <> '') AS legal_forms,
  bool_or(mapped_by_seed) AS mapped_by_seed FROM lookup GROUP BY company
UNION ALL SELECT -1, 'Unknown', 0, NULL, false""")
def _(spark, sf):
    return ST.dim_company(lookup_table(spark, sf))


MARTS_SQL = f"""{WITH_SILVER},
mart_companies AS (SELECT CAST(row_number() OVER (ORDER BY company) AS INTEGER) AS company_key, company
  FROM (SELECT DISTINCT company FROM lookup)),
mart_products AS (SELECT CAST(row_number() OVER (ORDER BY product, sub_product) AS INTEGER) AS product_key, *
  FROM (SELECT DISTINCT product, sub_product, product_group FROM silver)),
mart_states AS (SELECT CAST(row_number() OVER (ORDER BY state_code) AS INTEGER) AS state_key, * FROM state_ref
  UNION ALL SELECT -1, 'NA', 'Unknown', 'Unknown')"""


@query("kd3_dim_product_marts", f"{MARTS_SQL} SELECT * FROM mart_products")
def _(spark, sf):
    return mart_tables(spark, sf)["dim_product"]


@query("kd5_dim_state_marts", f"""{MARTS_SQL}
SELECT m.*, count(complaint_id) AS complaints FROM mart_states m LEFT JOIN silver s ON ifnull(s.state, 'NA') = m.state_code GROUP BY ALL""")
def _(spark, sf):
    marts = mart_tables(spark, sf)
    per_state = marts["fct_complaints"].groupBy("state_key").agg(F.count("*").alias("complaints"))
    states = marts["dim_state"].join(per_state, "state_key", "left")
    return states.withColumn("complaints", F.coalesce("complaints", F.lit(0)))


@query("kd7_fct_complaints", f"""{MARTS_SQL}
SELECT complaint_id, ifnull(CAST(strftime(date_received, '%Y%m%d') AS INTEGER), -1) AS date_received_key,
  ifnull(CAST(strftime(date_sent_to_company, '%Y%m%d') AS INTEGER), -1) AS date_sent_key,
  ifnull(company_key, -1) AS company_key, product_key, ifnull(state_key, -1) AS state_key, issue, submitted_via,
  company_response, 1 AS complaint_count, days_to_send, CAST(is_timely AS INTEGER) AS is_timely,
  CAST(is_disputed AS INTEGER) AS is_disputed, CAST(narrative IS NOT NULL AS INTEGER) AS has_narrative,
  dq_sent_before_received, dq_invalid_state
FROM silver s LEFT JOIN mart_companies USING (company) JOIN mart_products USING (product, sub_product)
  LEFT JOIN mart_states m ON m.state_code = s.state""")
def _(spark, sf):
    return mart_tables(spark, sf)["fct_complaints"]


@query("kq1_group_by_year", f"""{STAR_SQL}
SELECT year, product_group, CAST(sum(complaint_count) AS BIGINT) AS complaints FROM fact
JOIN dates ON date_key = date_received_key JOIN products USING (product_key) WHERE year BETWEEN 1996 AND 2000 GROUP BY ALL""")
def _(spark, sf):
    return ST.group_by_year(star_tables(spark, sf), 1996, 2000)


@query("kq1_renamed_products", f"""{STAR_SQL}
SELECT product_group, product, min(full_date) AS first_seen, max(full_date) AS last_seen,
  CAST(sum(complaint_count) AS BIGINT) AS complaints
FROM fact JOIN dates ON date_key = date_received_key JOIN products USING (product_key) GROUP BY 1, 2""")
def _(spark, sf):
    return ST.renamed_products(star_tables(spark, sf))


@query("kq1_timely_by_region", f"""{STAR_SQL}
SELECT region, CAST(sum(complaint_count) AS BIGINT) AS complaints,
  round(100.0 * sum(is_timely) / count(is_timely), 2) AS timely_pct
FROM fact JOIN states USING (state_key) GROUP BY region""")
def _(spark, sf):
    return ST.timely_by_region(star_tables(spark, sf))


@query("kq1_by_weekday", f"""{STAR_SQL}
SELECT is_weekend, day_name, CAST(sum(complaint_count) AS BIGINT) AS complaints
FROM fact JOIN dates ON date_key = date_received_key WHERE year = 1998 GROUP BY ALL""")
def _(spark, sf):
    return ST.by_weekday(star_tables(spark, sf), 1998)


@query("c5_received_and_sent_months", f"""{STAR_SQL}
SELECT a.year_month AS received_month, b.year_month AS sent_month, CAST(sum(complaint_count) AS BIGINT) AS complaints
FROM fact JOIN dates a ON a.date_key = date_received_key JOIN dates b ON b.date_key = date_sent_key
WHERE a.year = 1998 AND a.month = 12 GROUP BY 1, 2""")
def _(spark, sf):
    return ST.received_and_sent_months(star_tables(spark, sf), 1998, 12)


@query("d8_ratio_of_sums_and_mean_of_ratios", f"""{STAR_SQL},
per AS (SELECT company_key, sum(is_timely) AS t, count(is_timely) AS a FROM fact
  JOIN dates ON date_key = date_received_key WHERE year = 1998 GROUP BY 1)
SELECT count(*) AS groups, round(100.0 * sum(t) / sum(a), 2) AS ratio_of_sums, round(avg(100.0 * t / a), 2) AS mean_of_ratios
FROM per WHERE a > 0""")
def _(spark, sf):
    return ST.timely_rates(star_tables(spark, sf), 1998)


@query("c8_fan_out", f"""{STAR_SQL}
SELECT (SELECT CAST(sum(complaint_count) AS BIGINT) FROM fact) AS real_total,
  (SELECT CAST(sum(complaint_count) AS BIGINT) FROM fact JOIN products p USING (product_key)
   JOIN products q ON q.product = p.product) AS inflated_total""")
def _(spark, sf):
    return ST.product_fan_out(star_tables(spark, sf))


@query("l10_grain", f"""{STAR_SQL},
n AS (SELECT (SELECT count(DISTINCT complaint_id) FROM complaints) AS source_complaints,
  (SELECT count(*) FROM fact) AS fact_rows, (SELECT count(DISTINCT complaint_id) FROM fact) AS fact_distinct_ids)
SELECT *, if(source_complaints = fact_rows AND fact_rows = fact_distinct_ids, 'PASS', 'FAIL') AS status FROM n""")
def _(spark, sf):
    return ST.grain_check(star_tables(spark, sf), typed_table(spark, sf))


ORPHANS_SQL = " UNION ALL ".join(
    f"SELECT '{label}' AS fk, count(*) AS orphans FROM fact ANTI JOIN {dim} ON {dim}.{pk} = fact.{fk}"
    for label, fk, dim, pk in [
        ("date_received", "date_received_key", "dates", "date_key"), ("date_sent", "date_sent_key", "dates", "date_key"),
        ("company", "company_key", "companies", "company_key"), ("product", "product_key", "products", "product_key"),
        ("issue", "issue_key", "issues", "issue_key"), ("state", "state_key", "states", "state_key"),
        ("response", "response_key", "responses", "response_key"),
    ]
)


@query("c9_orphans", f"{STAR_SQL} {ORPHANS_SQL}")
def _(spark, sf):
    return ST.orphan_check(star_tables(spark, sf))


@query("c9_orphans_short_calendar", f"""{STAR_SQL}
SELECT 'date_sent' AS fk, count(*) AS orphans FROM fact
ANTI JOIN (SELECT date_key FROM dates WHERE year IS NULL OR year < 2000) d ON d.date_key = fact.date_sent_key""")
def _(spark, sf):
    # a failing input: sent dates after 1999 find no day
    from caselake.operators.joins import orphan_count

    star = star_tables(spark, sf)
    short = star["dim_date"].filter("year IS NULL OR year < 2000")
    return orphan_count(star["fact_complaints"], short, "date_sent_key", "date_key", "date_sent")


SQL_NAMES = {
    "dim_company": ("companies", ["company_name_raw"]),
    "dim_product": ("products", ["product", "sub_product"]),
    "dim_issue": ("issues", ["issue", "sub_issue"]),
    "dim_state": ("states", ["state_code"]),
    "dim_response": ("responses", ST.RESPONSE_FLAGS),
    "dim_date": ("dates", ["date_key"]),
}


@query("l10_duplicate_natural_keys", STAR_SQL + " UNION ALL ".join(
    f" SELECT '{dim}' AS dim, count(*) - count(DISTINCT ({', '.join(cols)})) AS duplicates FROM {name}"
    for dim, (name, cols) in SQL_NAMES.items()
))
def _(spark, sf):
    return ST.duplicate_key_check(star_tables(spark, sf))


@query("l10_totals", f"""{STAR_SQL}
SELECT *, if(star_total = raw_total, 'PASS', 'FAIL') AS status FROM (SELECT
  (SELECT CAST(sum(complaint_count) AS BIGINT) FROM fact) AS star_total,
  (SELECT count(*) FROM complaints WHERE complaint_id IS NOT NULL) AS raw_total)""")
def _(spark, sf):
    return ST.total_check(star_tables(spark, sf), typed_table(spark, sf))


@query("d15_unknown_members", f"""{STAR_SQL}
SELECT count(*) FILTER (company_key = -1) AS unknown_company, count(*) FILTER (state_key = -1) AS unknown_state,
  count(*) FILTER (date_sent_key = -1) AS unknown_date_sent, count(*) FILTER (is_timely IS NULL) AS unknown_timely FROM fact""")
def _(spark, sf):
    return ST.unknown_members(star_tables(spark, sf))


@query("g1_table_sizes", STAR_SQL + " UNION ALL ".join(
    f" SELECT '{dim}' AS table_name, count(*) AS row_count FROM {name}"
    for dim, name in [("fact_complaints", "fact"), *[(d, n) for d, (n, _) in SQL_NAMES.items()]]
))
def _(spark, sf):
    return ST.table_sizes(star_tables(spark, sf))
