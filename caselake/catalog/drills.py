"""Joins, null handling, aggregates, windows, ordering and lookups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caselake.catalog.layers import (
    SEEDS_SQL, WITH_SILVER, bronze_table, silver_table, text_sql, typed_table,
)
from caselake.catalog.questions import ONLY, WITH
from caselake.catalog.registry import query
from caselake.catalog.standin import RAW_SQL, TYPED_SQL, raw_complaints, table, typed_complaints
from caselake.catalog.stars import _group_sql
from caselake.functions import columns as C
from caselake.operators import aggregates as G
from caselake.operators import joins as J
from caselake.operators import numbering as N
from caselake.operators import profiles as P
from caselake.plans import analysis as A
from caselake.session import materialise, scratch_path
from caselake.sources.files import COMPLAINT_TARGETS
from caselake.sources.relations import inline_relation, seed_rows, unnest_values

# the states (and DC) of the zero-preserving join
STATES = [code for code, _, region in seed_rows("state_ref") if region != "Territory / military"]
STATES_SQL = "members AS (SELECT unnest([" + ", ".join(f"'{s}'" for s in STATES) + "]) AS state)"
# A small lookup of regions.
REGIONS = [
    ("TX", "South"), ("FL", "South"), ("GA", "South"), ("CA", "West"), ("WA", "West"), ("NY", "Northeast"),
    ("PA", "Northeast"), ("IL", "Midwest"), ("OH", "Midwest"), ("WY", "West"),
]
REGIONS_SQL = "regions(state, region) AS (VALUES " + ", ".join(f"('{s}', '{r}')" for s, r in REGIONS) + ")"
DAY, COMPANY, SINCE = date(1998, 3, 3), "EQUIFAX, INC.", date(2001, 7, 1)


# ---- projections and predicates --------------------------------------------------------------


@query("b1_text_normalisation", f"""WITH {RAW_SQL}
SELECT {text_sql('product', 'Unknown')} AS product, {text_sql('sub_product', 'N/A')} AS sub_product,
  {text_sql('company')} AS company, {text_sql('consumer_disputed', 'Not collected')} AS disputed, count(*) AS n
FROM raw GROUP BY ALL""")
def _(spark, sf):
    raw = raw_complaints(spark, sf)
    return raw.groupBy(
        C.clean_text("product", "Unknown").alias("product"),
        C.clean_text("sub_product", "N/A").alias("sub_product"),
        C.clean_text("company").alias("company"),
        C.clean_text("consumer_disputed", "Not collected").alias("disputed"),
    ).agg(F.count("*").alias("n"))


@query("b2_safe_casts", f"""WITH {RAW_SQL}
SELECT complaint_id AS id_text, TRY_CAST(trim(complaint_id) AS BIGINT) AS id, date_received AS day_text,
  TRY_CAST(trim(date_received) AS DATE) AS day FROM raw""")
def _(spark, sf):
    return raw_complaints(spark, sf).select(
        F.col("complaint_id").alias("id_text"),
        C.safe_long("complaint_id").alias("id"),
        F.col("date_received").alias("day_text"),
        C.safe_date("date_received").alias("day"),
    )


@query("b3_yes_no_flags", f"""WITH {RAW_SQL}
SELECT map {{'Yes': true, 'No': false}}[trim(timely_response)] AS is_timely,
  map {{'Yes': 1, 'No': 0}}[trim(consumer_disputed)] AS disputed, count(*) AS n FROM raw GROUP BY ALL""")
def _(spark, sf):
    flags = raw_complaints(spark, sf).select(
        C.yes_no("timely_response").alias("is_timely"), C.flag_to_int(C.yes_no("consumer_disputed")).alias("disputed")
    )
    return flags.groupBy("is_timely", "disputed").agg(F.count("*").alias("n"))


@query("b4_product_group_case", f"""WITH {TYPED_SQL}
SELECT product, {_group_sql('product')} AS product_group, count(*) AS n FROM complaints GROUP BY ALL""")
def _(spark, sf):
    per_product = G.count_by(typed_complaints(spark, sf), "product")
    return per_product.select("product", C.product_group("product").alias("product_group"), "n")


@query("b5_p1_by_id", f"{ONLY} SELECT * FROM complaints WHERE complaint_id = 42")
def _(spark, sf):
    return A.p1_by_id(typed_table(spark, sf), 42)


@query("b6_p2_issues_of_company", f"""{ONLY}
SELECT issue, count(*) AS n FROM complaints WHERE company = '{COMPANY}'
  AND date_received >= DATE '1997-01-01' AND date_received < DATE '1998-01-01' GROUP BY issue""")
def _(spark, sf):
    return A.p2_issues_of_company(typed_table(spark, sf), COMPANY, date(1997, 1, 1), date(1998, 1, 1))


@query("b7_p3a_one_day_formatted", f"{ONLY} SELECT count(*) AS n FROM complaints WHERE strftime(date_received, '%Y-%m-%d') = '{DAY}'")
def _(spark, sf):
    return A.p3a_one_day_formatted(typed_table(spark, sf), DAY)


@query("b7_p3b_one_day", f"{ONLY} SELECT count(*) AS n FROM complaints WHERE date_received = DATE '{DAY}'")
def _(spark, sf):
    return A.p3b_one_day(typed_table(spark, sf), DAY)


@query("b8_comparisons", f"""{ONLY}
SELECT product, count(*) AS n FROM complaints WHERE date_received BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
  AND state NOT IN ('XX', 'None') AND submitted_via <> 'Fax' AND sub_issue IS NOT NULL GROUP BY product""")
def _(spark, sf):
    rows = typed_complaints(spark, sf).filter(
        F.col("date_received").between(date(1996, 1, 1), date(1999, 12, 31))
        & ~F.col("state").isin("XX", "None")
        & (F.col("submitted_via") != "Fax")
        & F.col("sub_issue").isNotNull()
    )
    return G.count_by(rows, "product")


@query("b9_prefix_any_case", f"{ONLY} SELECT product, count(*) AS n FROM complaints WHERE product ILIKE 'CREDIT reporting%' GROUP BY 1")
def _(spark, sf):
    return G.count_by(typed_complaints(spark, sf).filter(F.col("product").ilike("CREDIT reporting%")), "product")


@query("b10_literal_prefix", f"""{ONLY}
SELECT count(*) FILTER (starts_with(company, 'EQUIFAX')) AS named, count(*) FILTER (starts_with(company, '%')) AS percent,
  count(*) FILTER (starts_with(company, 'E_U')) AS underscore,
  count(*) FILTER (starts_with(lower(company), 'equifax')) AS any_case FROM complaints""")
def _(spark, sf):
    return typed_complaints(spark, sf).agg(
        F.count_if(C.starts_with("company", "EQUIFAX")).alias("named"),
        F.count_if(C.starts_with("company", "%")).alias("percent"),
        F.count_if(C.starts_with("company", "E_U")).alias("underscore"),
        F.count_if(C.starts_with("company", "EQUIFAX", ignore_case=True)).alias("any_case"),
    )


@query("b11_alias_then_filter", f"{ONLY} SELECT product AS p, count(*) AS n FROM complaints WHERE p = 'Mortgage' GROUP BY p")
def _(spark, sf):
    named = typed_complaints(spark, sf).withColumn("p", F.col("product"))
    return G.count_by(named.filter(F.col("p") == "Mortgage"), "p")


@query("b12_star_and_flags", f"""{ONLY}
SELECT *, ifnull(date_sent_to_company < date_received, false) AS sent_first, state IS NULL AS no_state FROM complaints""")
def _(spark, sf):
    sent_first = F.coalesce(F.col("date_sent_to_company") < F.col("date_received"), F.lit(False))
    return typed_table(spark, sf).select(
        "*", sent_first.alias("sent_first"), F.col("state").isNull().alias("no_state")
    )


@query("b13_bound_parameters", f"""{ONLY}
SELECT complaint_id, company, date_received FROM complaints WHERE starts_with(company, 'Equifax') AND date_received >= DATE '2001-07-15'
ORDER BY date_received DESC, complaint_id, company LIMIT 500""")
def _(spark, sf):
    typed_table(spark, sf).createOrReplaceTempView("typed_complaints")
    return spark.sql(
        """SELECT complaint_id, company, date_received FROM typed_complaints
           WHERE startswith(company, :prefix) AND date_received >= :since
           ORDER BY date_received DESC, complaint_id NULLS LAST, company LIMIT :lim""",
        args={"prefix": "Equifax", "since": date(2001, 7, 15), "lim": max(1, min(100_000, 500))},
    )


# ---- joins -----------------------------------------------------------------------------------


@query("c6_zero_preserving_count", f"""{WITH}{STATES_SQL}
SELECT m.state, count(c.complaint_id) AS mortgages FROM members m
LEFT JOIN complaints c ON c.state = m.state AND c.product = 'Mortgage' AND c.date_received >= DATE '{SINCE}' GROUP BY 1""")
def _(spark, sf):
    recent = (F.col("product") == "Mortgage") & (F.col("date_received") >= F.lit(SINCE))
    members = unnest_values(spark, STATES, "state")
    return J.zero_preserving_count(members, typed_complaints(spark, sf), "state", "complaint_id", recent, "mortgages")


@query("c6_matched_only_count", f"""{WITH}{STATES_SQL}
SELECT m.state, count(c.complaint_id) AS mortgages FROM members m LEFT JOIN complaints c ON c.state = m.state
WHERE c.product = 'Mortgage' AND c.date_received >= DATE '{SINCE}' GROUP BY 1""")
def _(spark, sf):
    recent = (F.col("product") == "Mortgage") & (F.col("date_received") >= F.lit(SINCE))
    members = unnest_values(spark, STATES, "state")
    return J.matched_only_count(members, typed_complaints(spark, sf), "state", "complaint_id", recent, "mortgages")


@query("c6_states_per_form", f"""{WITH}{STATES_SQL}
SELECT (SELECT count(DISTINCT m.state) FROM members m LEFT JOIN complaints c ON c.state = m.state
  WHERE c.product = 'Mortgage' AND c.date_received >= DATE '{SINCE}') AS with_where_filter,
  (SELECT count(*) FROM members) AS with_on_filter""")
def _(spark, sf):
    recent = (F.col("product") == "Mortgage") & (F.col("date_received") >= F.lit(SINCE))
    members = unnest_values(spark, STATES, "state")
    matched = J.matched_only_count(members, typed_complaints(spark, sf), "state", "complaint_id", recent, "n")
    return members.agg(
        matched.select(F.count("*")).scalar().alias("with_where_filter"), F.count("*").alias("with_on_filter")
    )


@query("c7_temporal_join", """
WITH versions AS (
  SELECT c_custkey AS id, c_name AS name, DATE '1900-01-01' AS valid_from, CASE WHEN c_custkey % 3 = 0 THEN DATE '1998-01-01' END AS valid_to FROM customer
  UNION ALL SELECT c_custkey, c_name || ' II', DATE '1998-01-01', NULL FROM customer WHERE c_custkey % 3 = 0)
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, name, valid_to IS NULL AS is_current FROM orders
JOIN versions ON id = o_custkey AND CAST(o_orderdate AS DATE) >= valid_from AND CAST(o_orderdate AS DATE) < ifnull(valid_to, DATE '9999-12-31')""")
def _(spark, sf):
    customers = table(spark, sf, "customer")
    renamed, change = F.col("c_custkey") % 3 == 0, F.lit(date(1998, 1, 1))
    old = customers.select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"),
        F.lit(date(1900, 1, 1)).alias("valid_from"), F.when(renamed, change).alias("valid_to"),
    )
    new = customers.filter(renamed).select(
        F.col("c_custkey").alias("o_custkey"), F.concat("c_name", F.lit(" II")).alias("name"),
        change.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    joined = J.temporal_join(orders, old.unionByName(new), ["o_custkey"], "day")
    return joined.select("o_orderkey", "day", "name", F.col("valid_to").isNull().alias("is_current"))


@query("c7_temporal_join_long_histories", """
WITH v AS (SELECT event_type AS kind, CAST(ts AS DATE) AS valid_from, count(*) AS said FROM events GROUP BY ALL),
versions AS (SELECT *, lead(valid_from) OVER (PARTITION BY kind ORDER BY valid_from) AS valid_to FROM v)
SELECT e.event_id, kind, valid_from, said FROM events e JOIN versions ON kind = e.event_type
  AND CAST(e.ts AS DATE) + 3 >= valid_from AND CAST(e.ts AS DATE) + 3 < ifnull(valid_to, DATE '9999-12-31')""")
def _(spark, sf):
    # every kind of event has a version for each day it occurred on; asked for three days after the event
    events = table(spark, sf, "events").select("event_id", F.col("event_type").alias("kind"), F.to_date("ts").alias("day"))
    counted = events.groupBy("kind", F.col("day").alias("valid_from")).agg(F.count("*").alias("said"))
    later = Window.partitionBy("kind").orderBy("valid_from")  # days of one kind
    versions = materialise(counted.withColumn("valid_to", F.lead("valid_from").over(later)), "versions")
    joined = J.temporal_join(events.withColumn("at", F.date_add("day", 3)), versions, ["kind"], "at", long_history=8)
    return joined.select("event_id", "kind", "valid_from", "said")


@query("c10_not_exists", """
SELECT count(*) AS n FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c
  WHERE CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END = o.o_custkey)""")
def _(spark, sf):
    listed = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")).alias("k")
    )
    return J.not_exists(table(spark, sf, "orders"), "o_custkey", listed, "k").agg(F.count("*").alias("n"))


@query("c11_not_in_with_null", """
SELECT count(*) AS n FROM orders WHERE o_custkey NOT IN (
  SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END FROM customer)""")
def _(spark, sf):
    listed = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")).alias("k")
    )
    return J.not_in(table(spark, sf, "orders"), "o_custkey", listed, "k").agg(F.count("*").alias("n"))


@query("c11_not_in_without_null", """
SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""")
def _(spark, sf):
    listed = table(spark, sf, "customer").filter(F.col("c_mktsegment") != "BUILDING").select("c_custkey")
    return J.not_in(table(spark, sf, "orders"), "o_custkey", listed, "c_custkey").select("o_orderkey")


@query("c12_in_either", f"""WITH {TYPED_SQL}, {SEEDS_SQL}
SELECT complaint_id, issue FROM complaints
WHERE issue IN (SELECT issue_raw FROM issue_map) OR issue IN (SELECT issue_clean FROM issue_map)""")
def _(spark, sf):
    from caselake.sources.relations import load_seed

    renamed, rows = load_seed(spark, "issue_map"), typed_complaints(spark, sf)
    doubled = rows.select("complaint_id", "issue", F.col("issue").alias("issue_again"))
    kept = J.in_either(doubled, "issue", renamed.select("issue_raw"), "issue_again", renamed.select("issue_clean"))
    return kept.select("complaint_id", "issue")


@query("c15_small_lookup_then_group", f"""{WITH}{REGIONS_SQL}
SELECT region, count(*) AS n FROM complaints JOIN regions USING (state) GROUP BY region""")
def _(spark, sf):
    regions = inline_relation(spark, REGIONS, "state STRING, region STRING")
    per_state = G.count_by(typed_complaints(spark, sf), "state")
    joined = J.lookup_join(per_state, regions, ["state"], "inner")
    return joined.groupBy("region").agg(F.sum("n").alias("n"))


# ---- aggregates ------------------------------------------------------------------------------


@query("d2_per_product_and_day", f"""{ONLY}
SELECT product, date_received, count(*) AS n FROM complaints GROUP BY ALL""")
def _(spark, sf):
    return G.count_by(typed_complaints(spark, sf), "product", "date_received")


@query("d3_count_kinds", f"""{ONLY}
SELECT product, count(*) AS all_rows, count(sub_issue) AS known_rows, count(DISTINCT sub_issue) AS distinct_values
FROM complaints GROUP BY product""")
def _(spark, sf):
    return G.count_kinds(typed_complaints(spark, sf), ["product"], "sub_issue")


@query("d4_distinct_combinations", f"""{ONLY}
SELECT count(DISTINCT (sub_issue, company)) AS combinations FROM complaints""")
def _(spark, sf):
    return typed_complaints(spark, sf).agg(G.distinct_combinations(["sub_issue", "company"]).alias("combinations"))


@query("d5_sum_avg_min_max", f"""{WITH}
d AS (SELECT submitted_via, date_diff('day', date_received, date_sent_to_company) AS days FROM complaints)
SELECT submitted_via, CAST(sum(days) AS BIGINT) AS total, round(avg(days), 4) AS mean, min(days) AS low, max(days) AS high
FROM d GROUP BY 1""")
def _(spark, sf):
    days = typed_complaints(spark, sf).select(
        "submitted_via", C.days_between("date_received", "date_sent_to_company").alias("days")
    )
    return days.groupBy("submitted_via").agg(
        F.sum("days").alias("total"), C.round_half(F.avg("days"), 4).alias("mean"),
        F.min("days").alias("low"), F.max("days").alias("high"),
    )


@query("d6_filtered_count", f"""{ONLY}
SELECT product, count(*) FILTER (timely_response = 'No') AS late, count(*) FILTER (state = 'CA') AS californian
FROM complaints GROUP BY product""")
def _(spark, sf):
    return typed_complaints(spark, sf).groupBy("product").agg(
        G.filtered_count(F.col("timely_response") == "No").alias("late"),
        G.filtered_count(F.col("state") == "CA").alias("californian"),
    )


@query("d7_null_safe_rate", f"""WITH {RAW_SQL}
SELECT company, round(100.0 * count(*) FILTER (trim(timely_response) = 'No')
  / nullif(count(*) FILTER (trim(timely_response) IN ('Yes', 'No')), 0), 2) AS late_pct FROM raw GROUP BY company""")
def _(spark, sf):
    timely = C.yes_no("timely_response")
    return raw_complaints(spark, sf).groupBy("company").agg(C.pct(F.count_if(~timely), F.count(timely)).alias("late_pct"))


@query("d9_having", f"{ONLY} SELECT state, count(*) AS n FROM complaints GROUP BY state HAVING count(*) >= 2500")
def _(spark, sf):
    return G.count_by(typed_complaints(spark, sf), "state").filter("n >= 2500")


@query("d10_percentiles", """
SELECT l_returnflag, count(*) AS n, quantile_cont(l_quantity, 0.5) AS median, quantile_cont(l_quantity, 0.95) AS p95
FROM lineitem GROUP BY 1""")
def _(spark, sf):
    return G.exact_percentiles(
        table(spark, sf, "lineitem"), ["l_returnflag"], "l_quantity", {"median": 0.5, "p95": 0.95}
    )


@query("d10_percentiles_many_values", """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(quantile_cont(l_extendedprice, 0.25), 6) AS p25, round(quantile_cont(l_extendedprice, 0.5), 6) AS median,
  round(quantile_cont(l_extendedprice, 0.999), 6) AS p999 FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    # nearly every price is a value of its own
    found = G.exact_percentiles(
        table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", {"p25": 0.25, "median": 0.5, "p999": 0.999}
    )
    return found.select("l_returnflag", "l_linestatus", "n", *[F.round(c, 6).alias(c) for c in ("p25", "median", "p999")])


@query("d11_ordered_text", f"""{ONLY}
SELECT product, string_agg(DISTINCT issue, ' | ' ORDER BY issue) AS issues FROM complaints GROUP BY product""")
def _(spark, sf):
    return typed_complaints(spark, sf).groupBy("product").agg(G.joined_text("issue").alias("issues"))


@query("d14_first_and_last_seen", f"""{ONLY}
SELECT product, issue, min(date_received) AS first_seen, max(date_received) AS last_seen, count(*) AS n FROM complaints GROUP BY 1, 2""")
def _(spark, sf):
    return G.first_and_last_seen(typed_complaints(spark, sf), ["product", "issue"], "date_received")


PROFILED = [c for c in COMPLAINT_TARGETS]


@query("d16_distinct_profile", f"""WITH {RAW_SQL}
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, min({c}) AS min, max({c}) AS max, count(DISTINCT {c}) AS unique_values, count(*) AS count, "
    f"round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 2) AS null_percentage FROM raw" for c in PROFILED
))
def _(spark, sf):
    return G.distinct_profile(bronze_table(spark, sf), PROFILED)


# kinds of the columns of lineitem, with the text of a value and (for quantiles) its number in both engines
_PROFILED = {
    **{c: ("bigint", "{0}", "{0}") for c in ("l_orderkey", "l_partkey", "l_suppkey")},
    "l_linenumber": ("int", "{0}", "{0}"),
    **{c: ("double", "CAST({0} AS DECIMAL(18, 4))", "{0}") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")},
    **{c: ("string", "{0}", None) for c in ("l_returnflag", "l_linestatus")},
    "l_shipdate": ("timestamp_ntz", "strftime({0}, '%Y-%m-%d %H:%M:%S')", None),
}


def _profile_sql(c: str, kind: str, text: str, number: str | None) -> str:
    low, high = (f"CAST({text.format(f'{f}({c})')} AS VARCHAR)" for f in ("min", "max"))
    mean, spread = (f"round({f}({number.format(c)}), {d})" if number else "CAST(NULL AS DOUBLE)" for f, d in (("avg", 7), ("stddev", 4)))
    return f"""SELECT '{c}' AS column_name, CASE any_value(typeof({c})) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
  WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS column_type, {low} AS low, {high} AS high, {mean} AS mean, {spread} AS spread,
  count(*) AS rows, round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 2) AS null_percentage,
  true AS distinct_within_5_percent, true AS quantiles_within_1_percent FROM lineitem"""


def _distinct_values(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """``<column>_n``: the exact number of known values, each column counted on its own: side by side in one
    aggregate, every row would be repeated, with all columns, once per column."""
    counts = [df.agg(F.lit(f"{c}_n").alias("name"), F.count_distinct(F.col(f"`{c}`")).alias("n")) for c in columns]
    return {r["name"]: r["n"] for r in reduce(DataFrame.unionByName, counts).collect()} if counts else {}  # one row per column


@query("d16_profile", " UNION ALL ".join(_profile_sql(c, *how) for c, how in _PROFILED.items()))
def _(spark, sf):
    # every column of the table; sketches are stored per batch, one batch comes twice, and all are merged
    lines = table(spark, sf, "lineitem")
    batch, path = F.col("l_orderkey") % 3, scratch_path(spark, "profile_batches")
    P.store_sketches(P.batch_sketches(lines.filter(batch == 1).limit(5), batch), path)
    P.store_sketches(P.batch_sketches(lines, batch), path)
    found = P.merged_profile(P.stored_sketches(spark, path)).collect()  # one row per column
    # distinct counts and quantiles are estimates: their distance from exact counts over the same rows is reported
    value = lambda r, q: F.lit(r[q]).cast(r["column_type"])
    exact = []
    for r in found:
        for q in P.QUANTILES if r["q50"] is not None else ():
            c = r["column_name"]
            exact += [F.count_if(F.col(c) < value(r, q)).alias(f"{c}_{q}_below"), F.count_if(F.col(c) <= value(r, q)).alias(f"{c}_{q}_upto")]
    true = {**(lines.agg(*exact).first().asDict() if exact else {}), **_distinct_values(lines, [r["column_name"] for r in found])}

    def checked(r):
        c, n = r["column_name"], r["count"]
        ranks = [true[f"{c}_{q}_below"] <= (p + 0.01) * n and true[f"{c}_{q}_upto"] >= (p - 0.01) * n for q, p in P.QUANTILES.items() if r[q] is not None]
        near = abs(r["approx_unique"] - true[f"{c}_n"]) <= 0.05 * true[f"{c}_n"]
        text = (lambda v: f"{float(v):.4f}") if r["column_type"] == "double" else str
        figures = [None if r[f] is None else round(r[f], d) for f, d in (("avg", 7), ("std", 4))]
        return (c, r["column_type"], text(r["min"]), text(r["max"]), *figures, n, r["null_percentage"], near, all(ranks))

    kinds = "column_name STRING, column_type STRING, low STRING, high STRING, mean DOUBLE, spread DOUBLE, rows BIGINT, null_percentage DOUBLE, "
    return inline_relation(spark, [checked(r) for r in found], kinds + "distinct_within_5_percent BOOLEAN, quantiles_within_1_percent BOOLEAN")


@query("d17_null_percentages", f"WITH {RAW_SQL}\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 3) AS pct_null FROM raw" for c in PROFILED
))
def _(spark, sf):
    return G.null_percentages(raw_complaints(spark, sf), PROFILED)


@query("d18_distinct_members", f"{ONLY} SELECT DISTINCT issue, sub_issue FROM complaints")
def _(spark, sf):
    return typed_complaints(spark, sf).select("issue", "sub_issue").distinct()


# ---- windows ---------------------------------------------------------------------------------


@query("e3_range_and_rows_frames", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, count(*) OVER (ORDER BY CAST(o_orderdate AS DATE)) AS default_range_frame,
  count(*) OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey ROWS UNBOUNDED PRECEDING) AS rows_frame FROM orders""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return N.running_counts(orders, "day", "o_orderkey", range_rows=100)


@query("e6_ranks", f"""{WITH_SILVER},
s AS (SELECT state, count(*) AS n FROM silver WHERE state IS NOT NULL GROUP BY state)
SELECT state, n, row_number() OVER (ORDER BY n DESC, state) AS row_num, rank() OVER (ORDER BY n DESC) AS rnk,
  dense_rank() OVER (ORDER BY n DESC) AS dense_rnk FROM s""")
def _(spark, sf):
    # numbered by the scan, as for lists too long for one task
    counted = G.count_by(silver_table(spark, sf).filter(F.col("state").isNotNull()), "state")
    return G.ranks(counted, "n", "state", max_single_task=5)


@query("e6_ranks_with_ties", f"""{WITH}
s AS (SELECT state, count(*) AS n FROM complaints WHERE product = 'Credit card' AND date_received >= DATE '{SINCE}'
  AND state IS NOT NULL GROUP BY state)
SELECT state, n, row_number() OVER (ORDER BY n DESC, state) AS row_num, rank() OVER (ORDER BY n DESC) AS rnk,
  dense_rank() OVER (ORDER BY n DESC) AS dense_rnk FROM s""")
def _(spark, sf):
    rows = typed_complaints(spark, sf).filter(
        (F.col("product") == "Credit card") & (F.col("date_received") >= F.lit(SINCE)) & F.col("state").isNotNull()
    )
    return G.ranks(G.count_by(rows, "state"), "n", "state")


@query("e7_top_issues_with_ties", f"""{ONLY}
SELECT state, issue, count(*) AS n, dense_rank() OVER (PARTITION BY state ORDER BY count(*) DESC) AS rnk
FROM complaints GROUP BY state, issue QUALIFY rnk <= 3""")
def _(spark, sf):
    # A window over an aggregate, filtered on its result
    return G.top_n_per_group(G.count_by(typed_complaints(spark, sf), "state", "issue"), ["state"], "n", 3)


@query("e8_latest_per_key", """
SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def _(spark, sf):
    return N.latest_per_key(table(spark, sf, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")])


@query("e10_dense_keys", """
SELECT CAST(row_number() OVER (ORDER BY c_mktsegment, c_name) AS INTEGER) AS member_key, c_mktsegment, c_name
FROM (SELECT DISTINCT c_mktsegment, c_name FROM customer)""")
def _(spark, sf):
    # numbered in sampled ranges, as for member lists too long for one task
    members = table(spark, sf, "customer").select("c_mktsegment", "c_name").distinct()
    return N.dense_keys(members, ["c_mktsegment", "c_name"], "member_key", max_single_task=100, buckets=20)


@query("e11_global_rank", """
SELECT event_id, date_diff('day', TIMESTAMP '2024-01-01', date_trunc('day', ts)) AS age,
  rank() OVER (ORDER BY date_diff('day', TIMESTAMP '2024-01-01', date_trunc('day', ts)) DESC) AS rnk FROM events""")
def _(spark, sf):
    aged = table(spark, sf, "events").select(
        "event_id", C.days_between(F.lit(date(2024, 1, 1)), F.to_date("ts")).alias("age")
    )
    return N.global_rank(aged, "age", "rnk", range_rows=10)


# ---- order, limit, sample --------------------------------------------------------------------


@query("f2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def _(spark, sf):
    prices = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return G.top_k(prices, 25, F.desc("o_totalprice"), F.col("o_orderkey"))


@query("f3_nulls_last", f"""{ONLY}
SELECT complaint_id, date_sent_to_company FROM complaints ORDER BY date_sent_to_company DESC NULLS LAST, complaint_id NULLS LAST LIMIT 100""")
def _(spark, sf):
    rows = typed_complaints(spark, sf).select("complaint_id", "date_sent_to_company")
    return G.top_k(rows, 100, F.desc_nulls_last("date_sent_to_company"), F.asc_nulls_last("complaint_id"))


@query("f4_paging", "SELECT c_custkey, c_name FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20 OFFSET 40")
def _(spark, sf):
    page = G.page(table(spark, sf, "customer"), 40, 20, F.desc("c_acctbal"), F.col("c_custkey"))
    return page.select("c_custkey", "c_name")


@query("f4_far_page", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 30 OFFSET 9985")
def _(spark, sf):
    # from ranges with known counts: the files of all other ranges stay unread
    prices = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    ranges = G.write_for_paging(prices, scratch_path(spark, "pages"), ["o_totalprice", "o_orderkey"], ["o_totalprice"], part_rows=1000)
    return G.seek_page(ranges, 9985, 30)


ALL_LAST = ", ".join(f"{c} NULLS LAST" for c in COMPLAINT_TARGETS)


@query("f5_reproducible_sample", f"{ONLY} SELECT * FROM complaints ORDER BY md5(concat_ws(':', '42', complaint_id)), {ALL_LAST} LIMIT 5000")
def _(spark, sf):
    return G.reproducible_sample(typed_table(spark, sf), "complaint_id", 5000)


@query("h6_calendar_texts", """
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, monthname(o_orderdate) AS month_name,
  dayname(o_orderdate) AS day_name, CAST(isodow(o_orderdate) AS SMALLINT) AS day_of_week,
  CAST(quarter(o_orderdate) AS SMALLINT) AS quarter, CAST(o_orderdate - INTERVAL 7 DAY AS DATE) AS week_before FROM orders""")
def _(spark, sf):
    fields = C.calendar_fields(F.to_date("o_orderdate"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        C.date_key("o_orderdate").alias("date_key"),
        *[fields[name].alias(name) for name in ["month_name", "day_name", "day_of_week", "quarter"]],
        F.date_sub(F.to_date("o_orderdate"), 7).alias("week_before"),
    )


