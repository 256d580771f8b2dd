"""Business questions, lookups, aggregates, windows and ordering on typed complaints."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from caselake.catalog.registry import query
from caselake.catalog.standin import TYPED_SQL, typed_complaints
from caselake.plans import analysis as A

WITH = "WITH " + TYPED_SQL + ",\n"
ONLY = "WITH " + TYPED_SQL + "\n"
MONTHLY = """m AS (SELECT product, CAST(date_trunc('month', date_received) AS DATE) AS month, count(*) AS n
  FROM complaints GROUP BY ALL)"""
FIRST, END = date(1996, 1, 1), date(1997, 1, 1)


@query("q1_per_product_and_month", ONLY + """
SELECT product, CAST(date_trunc('month', date_received) AS DATE) AS month, count(*) AS complaints
FROM complaints GROUP BY ALL""")
def _(spark, sf):
    return A.q1_per_product_and_month(typed_complaints(spark, sf))


@query("q2_month_over_month", WITH + MONTHLY + """,
s AS (SELECT *, lag(n) OVER (PARTITION BY product ORDER BY month) AS prev_n FROM m)
SELECT product, month, n, prev_n, n - prev_n AS mom_change,
  round(100.0 * (n - prev_n) / nullif(prev_n, 0), 1) AS mom_pct FROM s""")
def _(spark, sf):
    return A.q2_month_over_month(typed_complaints(spark, sf))


@query("q3_top_issues_of_top_companies", WITH + """
big AS (SELECT company FROM complaints GROUP BY company ORDER BY count(*) DESC, company NULLS LAST LIMIT 10),
per_issue AS (SELECT company, issue, count(*) AS n FROM complaints WHERE company IN (FROM big) GROUP BY ALL)
SELECT company, dense_rank() OVER (PARTITION BY company ORDER BY n DESC) AS rnk, issue, n
FROM per_issue QUALIFY rnk <= 5""")
def _(spark, sf):
    return A.q3_top_issues_of_top_companies(typed_complaints(spark, sf))


@query("q4_running_total", WITH + f"""
daily AS (SELECT product, date_received AS d, count(*) AS n FROM complaints
  WHERE date_received >= DATE '{FIRST}' AND date_received < DATE '{END}' GROUP BY ALL)
SELECT product, d, n, CAST(sum(n) OVER (PARTITION BY product ORDER BY d ROWS UNBOUNDED PRECEDING) AS BIGINT)
  AS running_total FROM daily""")
def _(spark, sf):
    return A.q4_running_total(typed_complaints(spark, sf), FIRST, END)


@query("q5_late_responders", WITH + """
r AS (SELECT company, count(*) AS complaints, count(*) FILTER (timely_response = 'No') AS late
  FROM complaints GROUP BY company HAVING count(*) >= 100)
SELECT company, complaints, late, round(100.0 * late / complaints, 2) AS late_pct
FROM r ORDER BY late_pct DESC, complaints DESC, company NULLS LAST LIMIT 20""")
def _(spark, sf):
    return A.q5_late_responders(typed_complaints(spark, sf), min_complaints=100)


@query("q6_share_of_month", WITH + MONTHLY + """
SELECT month, product, n, round(100.0 * n / sum(n) OVER (PARTITION BY month), 2) AS pct_of_month FROM m""")
def _(spark, sf):
    return A.q6_share_of_month(typed_complaints(spark, sf))


@query("q7_moving_average", WITH + """
m AS (SELECT CAST(date_trunc('month', date_received) AS DATE) AS month, count(*) AS n
  FROM complaints WHERE product = 'Mortgage' GROUP BY ALL)
SELECT month, n, round(avg(n) OVER (ORDER BY month ROWS 2 PRECEDING), 1) AS ma_3m FROM m""")
def _(spark, sf):
    return A.q7_moving_average(typed_complaints(spark, sf), "Mortgage")


@query("q8_forwarding_days", WITH + """
d AS (SELECT submitted_via, date_diff('day', date_received, date_sent_to_company) AS days FROM complaints)
SELECT submitted_via, count(*) AS n, round(avg(days), 2) AS avg_days,
  quantile_cont(days, 0.5) AS median_days, quantile_cont(days, 0.95) AS p95_days
FROM d GROUP BY submitted_via""")
def _(spark, sf):
    return A.q8_forwarding_days(typed_complaints(spark, sf))
