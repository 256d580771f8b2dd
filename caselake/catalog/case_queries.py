"""Case-history questions: customers with events are cases, events are status changes."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.catalog.layers import typed_table
from caselake.catalog.questions import ONLY
from caselake.catalog.registry import query
from caselake.catalog.standin import company_name, company_sql, table
from caselake.operators import cases as K
from caselake.sources.files import COMPLAINT_TARGETS

STATUS = {"view": "OPN", "click": "INV", "error": "ESC", "purchase": "LGL", "signup": "CLS"}
TEAMS = {"ESC": "Complaints-Exec", "LGL": "Legal"}
NOW = datetime(2024, 2, 15)


def _texts(values: dict[str, str], c, default=None):
    chain = F
    for key, value in values.items():
        chain = chain.when(c == key, F.lit(value))
    return chain.otherwise(default)


def history_rows(spark: SparkSession, sf: str) -> DataFrame:
    code = _texts(STATUS, F.col("event_type"))
    tier = F.when(F.col("event_id") % 2 == 0, "Tier1").otherwise("Tier2")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("STAT_ID"),
        F.col("user_id").alias("CASE_ID"),
        code.alias("STAT_CD"),
        _texts(TEAMS, code, tier).alias("ASGN_TEAM"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("UPD_TS"),
    )


def history(spark: SparkSession, sf: str) -> DataFrame:
    return K.with_current_flag(history_rows(spark, sf))


def cases(spark: SparkSession, sf: str) -> DataFrame:
    customers, parts = table(spark, sf, "customer"), table(spark, sf, "part")
    return customers.join(parts, customers.c_custkey == parts.p_partkey).select(
        F.col("c_custkey").alias("CASE_ID"),
        (F.col("c_custkey") + 1_000_000).alias("CMPL_ID"),
        F.col("c_mktsegment").alias("PRD_DESC"),
        F.col("p_type").alias("ISS_DESC"),
        company_name().alias("CO_NM"),
        F.date_sub(F.lit(date(2024, 1, 1)), (F.col("c_custkey") % 40).cast("int")).alias("RCV_DT"),
    )


CASES_SQL = f"""WITH codes(STAT_CD, STAT_DESC) AS (VALUES {', '.join(str(c) for c in K.STATUS_CODES)}),
rows_ AS (SELECT event_id AS STAT_ID, user_id AS CASE_ID,
  map {{'view': 'OPN', 'click': 'INV', 'error': 'ESC', 'purchase': 'LGL', 'signup': 'CLS'}}[event_type] AS STAT_CD,
  CASE event_type WHEN 'error' THEN 'Complaints-Exec' WHEN 'purchase' THEN 'Legal'
    ELSE if(event_id % 2 = 0, 'Tier1', 'Tier2') END AS ASGN_TEAM, date_trunc('second', ts) AS UPD_TS FROM events),
history AS (SELECT *, CAST(STAT_ID = last_value(STAT_ID) OVER (PARTITION BY CASE_ID ORDER BY UPD_TS, STAT_ID
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS INTEGER) AS CUR_FLG FROM rows_),
cases AS (SELECT c_custkey AS CASE_ID, c_custkey + 1000000 AS CMPL_ID, c_mktsegment AS PRD_DESC, p_type AS ISS_DESC,
  {company_sql()} AS CO_NM, CAST(DATE '2024-01-01' - CAST(c_custkey % 40 AS INTEGER) AS DATE) AS RCV_DT
  FROM customer JOIN part ON p_partkey = c_custkey),
now_ AS (SELECT * FROM cases JOIN history USING (CASE_ID) WHERE CUR_FLG = 1)
"""


@query("k1_current_status", CASES_SQL + """
SELECT CMPL_ID, CO_NM, PRD_DESC, ISS_DESC, RCV_DT, STAT_CD, STAT_DESC, ASGN_TEAM, UPD_TS
FROM now_ JOIN codes USING (STAT_CD) WHERE CMPL_ID = 1000007""")
def _(spark, sf):
    return K.current_status(cases(spark, sf), history(spark, sf), K.status_codes(spark), 1_000_007)


@query("k2_case_history", CASES_SQL + """
SELECT UPD_TS, STAT_CD, STAT_DESC, ASGN_TEAM, CUR_FLG FROM cases JOIN history USING (CASE_ID) JOIN codes USING (STAT_CD)
WHERE CMPL_ID = 1000007""")
def _(spark, sf):
    return K.case_history(cases(spark, sf), history(spark, sf), K.status_codes(spark), 1_000_007)


@query("k3_escalated_cases", CASES_SQL + """
SELECT CMPL_ID, CO_NM, RCV_DT, ISS_DESC, STAT_CD, ASGN_TEAM FROM now_
WHERE starts_with(CO_NM, 'small') AND RCV_DT >= DATE '2023-12-01' AND STAT_CD IN ('ESC', 'LGL')
ORDER BY RCV_DT DESC, CMPL_ID LIMIT 50""")
def _(spark, sf):
    return K.escalated_cases(cases(spark, sf), history(spark, sf), "small", date(2023, 12, 1))


@query("k3_escalated_cases_any_case", CASES_SQL + """
SELECT CMPL_ID, CO_NM, RCV_DT, ISS_DESC, STAT_CD, ASGN_TEAM FROM now_
WHERE starts_with(lower(CO_NM), 'small') AND RCV_DT >= DATE '2000-01-01' AND STAT_CD IN ('ESC', 'LGL')
ORDER BY CO_NM DESC, CMPL_ID LIMIT 500""")
def _(spark, sf):
    return K.escalated_cases(
        cases(spark, sf), history(spark, sf), "SMALL", date(2000, 1, 1), 100_000, "company", ignore_case=True
    )


@query("k3_escalated_cases_sql", CASES_SQL + """
SELECT CMPL_ID, CO_NM, RCV_DT, ISS_DESC, STAT_CD, ASGN_TEAM FROM now_
WHERE starts_with(CO_NM, 'RED') AND RCV_DT >= DATE '2000-01-01' AND STAT_CD IN ('ESC', 'LGL') ORDER BY RCV_DT DESC, CMPL_ID LIMIT 50""")
def _(spark, sf):
    cases(spark, sf).createOrReplaceTempView("case_rows")
    history(spark, sf).createOrReplaceTempView("status_rows")
    return K.escalated_cases_sql(spark, "case_rows", "status_rows", "RED", date(2000, 1, 1))


@query("k4_status_counts", CASES_SQL + "SELECT STAT_CD, STAT_DESC, count(*) AS cases FROM now_ JOIN codes USING (STAT_CD) GROUP BY ALL")
def _(spark, sf):
    return K.status_counts(cases(spark, sf), history(spark, sf), K.status_codes(spark))


@query("k4_status_counts_prefix", CASES_SQL + """
SELECT STAT_CD, STAT_DESC, count(*) AS cases FROM now_ JOIN codes USING (STAT_CD) WHERE starts_with(CO_NM, 'hot') GROUP BY ALL""")
def _(spark, sf):
    return K.status_counts(cases(spark, sf), history(spark, sf), K.status_codes(spark), "hot")


@query("k5_code_usage", CASES_SQL + """
SELECT STAT_CD, STAT_DESC, count(*) FILTER (CUR_FLG = 1) AS current_cases, count(STAT_ID) AS all_history_rows
FROM codes LEFT JOIN history USING (STAT_CD) GROUP BY ALL""")
def _(spark, sf):
    return K.code_usage(history(spark, sf), K.status_codes(spark))


@query("k5_rows_and_cases", CASES_SQL + """
SELECT count(*) FILTER (STAT_CD = 'ESC') AS rows_all_history, count(*) FILTER (STAT_CD = 'ESC' AND CUR_FLG = 1) AS cases_now
FROM history""")
def _(spark, sf):
    return K.status_rows_and_cases(history(spark, sf), "ESC")


@query("k6_ever_in_status", CASES_SQL + """
SELECT PRD_DESC, count(DISTINCT CASE_ID) AS cases_ever FROM cases JOIN history USING (CASE_ID)
WHERE STAT_CD = 'ESC' AND RCV_DT >= DATE '2023-12-01' AND RCV_DT < DATE '2024-01-01' GROUP BY 1""")
def _(spark, sf):
    return K.ever_in_status(cases(spark, sf), history_rows(spark, sf), "ESC", date(2023, 12, 1), date(2024, 1, 1))


@query("k7_longest_waiting", CASES_SQL + """
SELECT CMPL_ID, CO_NM, STAT_CD, UPD_TS, date_diff('day', UPD_TS, TIMESTAMP '2024-02-15') AS days_since_update
FROM now_ WHERE STAT_CD <> 'CLS' ORDER BY days_since_update DESC, UPD_TS, CMPL_ID LIMIT 20""")
def _(spark, sf):
    return K.longest_waiting(cases(spark, sf), history(spark, sf), NOW)


@query("k8_current_flag", CASES_SQL + "SELECT * FROM history")
def _(spark, sf):
    return history(spark, sf)


@query("k9_hours_to_status", CASES_SQL + """
SELECT CMPL_ID, STAT_CD, date_diff('hour', CAST(RCV_DT AS TIMESTAMP), UPD_TS) AS hours_open,
  rank() OVER (ORDER BY hours_open DESC) AS rnk FROM now_ WHERE STAT_CD = 'LGL'""")
def _(spark, sf):
    return K.hours_to_status(cases(spark, sf), history(spark, sf), "LGL")


@query("k10_one_current_row", CASES_SQL + """
SELECT CASE_ID, CAST(sum(CASE WHEN STAT_CD <> 'CLS' THEN CUR_FLG ELSE 0 END) AS BIGINT) AS current_rows FROM history
GROUP BY 1 HAVING current_rows <> 1""")
def _(spark, sf):
    # a failing input: the flag is lost on closed rows, so closed cases have no current row
    broken = history(spark, sf).withColumn(
        "CUR_FLG", F.when(F.col("STAT_CD") != "CLS", F.col("CUR_FLG")).otherwise(0)
    )
    return K.not_exactly_one_current(broken)


@query("k11_cases_now", CASES_SQL + "SELECT count(*) AS cases_now FROM now_ WHERE STAT_CD = 'ESC' AND starts_with(CO_NM, 'red')")
def _(spark, sf):
    return K.cases_now(cases(spark, sf), history(spark, sf), "red", "ESC")


LAST = ", ".join(f"{c} NULLS LAST" for c in COMPLAINT_TARGETS)


@query("k12_case_extract", f"""{ONLY}
SELECT complaint_id AS CMPL_ID, left(product, 100) AS PRD_DESC, left(issue, 255) AS ISS_DESC, left(company, 255) AS CO_NM,
  left(state, 2) AS ST_CD, date_received AS RCV_DT, left(submitted_via, 30) AS CHNL,
  left(consumer_complaint_narrative, 4000) AS NARR_TXT, company_response_to_consumer AS RESP
FROM complaints WHERE complaint_id IS NOT NULL AND date_received IS NOT NULL
ORDER BY md5(concat_ws(':', '42', complaint_id)), {LAST} LIMIT 50000""")
def _(spark, sf):
    return K.case_extract(typed_table(spark, sf))


@query("h4_cases_per_month", CASES_SQL + """
SELECT make_date(year(RCV_DT), month(RCV_DT), 1) AS month, count(*) AS cases FROM cases GROUP BY 1 ORDER BY 1 DESC LIMIT 6""")
def _(spark, sf):
    return K.cases_per_month(cases(spark, sf))


@query("h1_code_texts", CASES_SQL + """
SELECT STAT_CD || ' = ' || STAT_DESC AS code_text, STAT_CD || '/' || STAT_DESC AS plus_text
FROM codes SEMI JOIN history USING (STAT_CD) ORDER BY STAT_CD LIMIT 3 OFFSET 1""")
def _(spark, sf):
    used = history_rows(spark, sf).select("STAT_CD").distinct()
    return K.code_texts(K.status_codes(spark).join(used, "STAT_CD", "left_semi"), offset=1)
