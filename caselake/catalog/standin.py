"""Complaints derived from the given tables.

Every line item is one raw complaint row: the order key is the complaint id (so ids repeat), the
order date the day received, the ship date the day sent. Values are spread over clean, blank and
broken spellings by key arithmetic. ``RAW_SQL`` states the same derivation for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.functions.columns import safe_date, safe_long
from caselake.sources.files import COMPLAINT_TARGETS, conform

PRODUCTS = [
    "Credit reporting", "Credit reporting or other personal consumer reports", "Debt collection",
    "Mortgage", "Credit card", "Prepaid card", "Bank account or service", "Checking or savings account",
    "Virtual currency", "Student loan", "Vehicle loan or lease", "Consumer Loan", "Crypto wallet", "", " Mortgage ",
]
ISSUES = [
    "Incorrect information on your report", "Incorrect information on credit report",
    "Improper use of your report", "Improper use of my credit report", "Attempts to collect debt not owed",
    "Cont'd attempts collect debt not owed", "Unable to get credit report/credit score",
    "Credit reporting company's investigation", "Trouble during payment process", "Managing an account", "", "Fees",
]
CHANNELS = ["Web", "Web", "Phone", "Referral", "Postal mail", "Fax", ""]
RESPONSES = ["Closed with explanation", "Closed with monetary relief", "In progress", ""]
STATES = [
    "CA", "TX", "NY", "FL", "ca", " WA ", "IL", "OH", "GA", "PA", "NJ", "VA", "MI", "NC", "AZ", "PR", "AE",
    "United States Minor Outlying Islands", "XX", "", "WY", "VT", "DC", "None", "HI",
]
DECORATIONS = 16
BIG_COMPANIES = ["EQUIFAX, INC.", "Equifax Information Services LLC", "Experian Information Solutions Inc."]
BATCHES = {"batch-a": "2001-06-01 00:00:00", "batch-b": "2001-06-30 00:00:00"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _mod(c: str, n: int) -> Column:
    return F.pmod(F.col(c), F.lit(n))


def company_name(part_key: str = "p_partkey", part_name: str = "p_name") -> Column:
    """A part name dressed up like a company name, in one of 16 ways."""
    name, key = F.col(part_name), F.col(part_key)
    one_form = F.element_at(F.array(F.lit(0), F.lit(1), F.lit(2), F.lit(12)), (F.pmod(key, F.lit(4)) + 1).cast("int"))
    style = F.when(name.like("%ring") | name.like("%bolt"), one_form).otherwise(F.pmod(key, F.lit(DECORATIONS)))
    upper = F.upper(name)
    return (
        F.when(style == 0, upper)
        .when(style == 1, F.concat(upper, F.lit(", INC.")))
        .when(style == 2, F.concat(name, F.lit(" Inc.")))
        .when(style == 3, F.concat(F.lit("The "), name, F.lit(" Company")))
        .when(style == 4, F.concat(name, F.lit(" LLC")))
        .when(style == 5, F.concat(upper, F.lit(" CORP.")))
        .when(style == 6, F.concat(upper, F.lit(" GROUP, INC.")))
        .when(style == 7, F.concat(name, F.lit(" & Co.")))
        .when(style == 8, F.concat(F.replace(name, F.lit(" "), F.lit("'s ")), F.lit(" Holdings LLC")))
        .when(style == 9, F.concat(name, F.lit(" National Association")))
        .when(style == 10, F.concat(name, F.lit(", N.A.")))
        .when(style == 11, F.concat(F.lit(" "), upper, F.lit(" INC")))
        .when(style == 12, F.concat(F.lit("  "), name, F.lit("  INCORPORATED ")))
        .when(style == 13, F.concat(name, F.lit(" Holding Ltd")))
        .when(style == 14, F.lit(""))
        .otherwise(F.concat(name, F.lit(" Limited L.P.")))
    )


def raw_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text rows in the Bronze layout.

    Customers meet the orders and parts meet the lines first; the lines then go to their orders, with only those
    texts of a part that they show. So the rows of one id come out of one task, whether parts can be broadcast or
    not, and who groups by id drops most copies before a shuffle. Texts of a part are made once per part, and those
    of a row when no join is left.
    """
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.to_date("l_shipdate").alias("shipped"),
        (flag * 4 + F.when(F.col("l_linestatus") == "F", 0).otherwise(2)).alias("flags"),
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("ordered"), F.substring("o_orderpriority", 1, 1).alias("priority"),
        F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2).alias("status"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", _mod("p_size", 2).alias("size_odd"), F.col("p_name").like("cold%").alias("cold"), company_name().alias("part_company"),
        F.when(_mod("p_size", 10) == 0, "").otherwise(F.col("p_type")).alias("sub_product"),
        F.when(_mod("p_size", 7) == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("sub_issue"),
        F.concat(F.lit("about "), F.col("p_name"), F.lit(", "), F.col("p_type")).alias("about"),
    )
    ordered = orders.join(customers, orders.o_custkey == customers.c_custkey).drop("o_custkey")
    supplier = _mod("l_suppkey", 3)
    described = lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "shipped", "cold", "sub_product", "sub_issue",
        (F.col("flags") + F.col("size_odd")).alias("issue_code"),
        F.when(supplier == 0, F.lit(None)).otherwise(F.col("part_company")).alias("part_company"),
        F.when(F.col("l_linenumber") <= 2, F.col("about")).alias("about"),
    )
    rows = described.join(ordered, described.l_orderkey == ordered.o_orderkey)
    key = F.col("l_orderkey").cast("string")
    received = F.date_format("ordered", "yyyy-MM-dd")
    broken_id, broken_day = _mod("l_partkey", 97), _mod("l_partkey", 89)
    priority = F.col("priority").cast("int") - 1
    timely = F.pmod(F.col("l_partkey") + F.col("l_linenumber"), F.lit(10))
    first_batch = F.col("l_linenumber") <= 4
    batch_a, batch_b = BATCHES
    return rows.select(
        F.when(broken_day == 3, "")
        .when(broken_day == 4, "not a date")
        .when(broken_day == 5, F.date_format("ordered", "yyyy/MM/dd"))
        .otherwise(received)
        .alias("date_received"),
        _pick(PRODUCTS, priority * 3 + F.col("status")).alias("product"),
        "sub_product",
        _pick(ISSUES, F.col("issue_code")).alias("issue"),
        "sub_issue",
        F.col("about").alias("consumer_complaint_narrative"),
        F.lit(None).cast("string").alias("company_public_response"),
        F.when(supplier == 0, _pick(BIG_COMPANIES, _mod("l_suppkey", 9) / 3)).otherwise(F.col("part_company")).alias("company"),
        _pick(STATES, _mod("c_nationkey", len(STATES))).alias("state"),
        F.lpad(_mod("c_custkey", 100000).cast("string"), 5, "0").alias("zip_code"),
        F.lit(None).cast("string").alias("tags"),
        F.lit(None).cast("string").alias("consumer_consent_provided"),
        _pick(CHANNELS, _mod("l_linenumber", 7)).alias("submitted_via"),
        F.when(_mod("l_suppkey", 31) == 0, "")
        .otherwise(F.date_format("shipped", "yyyy-MM-dd"))
        .alias("date_sent_to_company"),
        _pick(RESPONSES, _mod("l_suppkey", 4)).alias("company_response_to_consumer"),
        F.when(F.col("cold") | (timely == 0), "No").when(timely == 1, "").otherwise(" Yes").alias(
            "timely_response"
        ),
        _pick(["Yes", "No", "", "", ""], _mod("l_suppkey", 5)).alias("consumer_disputed"),
        F.when(broken_id == 5, F.concat(F.lit("x"), key))
        .when(broken_id == 6, "")
        .when(broken_id == 7, F.concat(F.lit(" "), key, F.lit(" ")))
        .otherwise(key)
        .alias("complaint_id"),
        F.when(first_batch, F.lit(BATCHES[batch_a])).otherwise(F.lit(BATCHES[batch_b])).cast("timestamp").alias("_ingested_at"),
        F.when(first_batch, F.lit(batch_a + ".csv")).otherwise(F.lit(batch_b + ".csv")).alias("_source_file"),
        F.when(first_batch, F.lit(batch_a)).otherwise(F.lit(batch_b)).alias("_batch_id"),
    )


def typed_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed table the business questions read (as loaded from the raw file)."""
    return conform(raw_complaints(spark, sf_dir).drop("_ingested_at", "_source_file", "_batch_id")).df


# ---- the same derivation for DuckDB ----------------------------------------------------------


def sql_text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(sql_text(v) for v in values) + "]"


def company_sql(part_key: str = "p_partkey", part_name: str = "p_name") -> str:
    style = (
        f"CASE WHEN {part_name} LIKE '%ring' OR {part_name} LIKE '%bolt' "
        f"THEN [0, 1, 2, 12][CAST({part_key} % 4 AS INTEGER) + 1] ELSE {part_key} % {DECORATIONS} END"
    )
    n = part_name
    return f"""CASE {style}
      WHEN 0 THEN upper({n}) WHEN 1 THEN upper({n}) || ', INC.' WHEN 2 THEN {n} || ' Inc.'
      WHEN 3 THEN 'The ' || {n} || ' Company' WHEN 4 THEN {n} || ' LLC' WHEN 5 THEN upper({n}) || ' CORP.'
      WHEN 6 THEN upper({n}) || ' GROUP, INC.' WHEN 7 THEN {n} || ' & Co.'
      WHEN 8 THEN replace({n}, ' ', '''s ') || ' Holdings LLC' WHEN 9 THEN {n} || ' National Association'
      WHEN 10 THEN {n} || ', N.A.' WHEN 11 THEN chr(160) || upper({n}) || ' INC'
      WHEN 12 THEN '  ' || {n} || '  INCORPORATED ' WHEN 13 THEN {n} || ' Holding Ltd' WHEN 14 THEN ''
      ELSE {n} || ' Limited L.P.' END"""


RAW_SQL = f"""raw AS (
  SELECT CASE l_partkey % 89 WHEN 3 THEN '' WHEN 4 THEN 'not a date' WHEN 5 THEN strftime(o_orderdate, '%Y/%m/%d')
           ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_received,
    {sql_list(PRODUCTS)}[(CAST(left(o_orderpriority, 1) AS INTEGER) - 1) * 3
      + CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END + 1] AS product,
    CASE WHEN p_size % 10 = 0 THEN '' ELSE p_type END AS sub_product,
    {sql_list(ISSUES)}[CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END * 4
      + CASE l_linestatus WHEN 'F' THEN 0 ELSE 2 END + p_size % 2 + 1] AS issue,
    CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_brand END AS sub_issue,
    CASE WHEN l_linenumber <= 2 THEN 'about ' || p_name || ', ' || p_type END AS consumer_complaint_narrative,
    CAST(NULL AS VARCHAR) AS company_public_response,
    CASE WHEN l_suppkey % 3 = 0 THEN {sql_list(BIG_COMPANIES)}[CAST(l_suppkey % 9 // 3 AS INTEGER) + 1]
      ELSE {company_sql()} END AS company,
    {sql_list(STATES)}[c_nationkey % {len(STATES)} + 1] AS state,
    lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip_code,
    CAST(NULL AS VARCHAR) AS tags,
    CAST(NULL AS VARCHAR) AS consumer_consent_provided,
    {sql_list(CHANNELS)}[l_linenumber % 7 + 1] AS submitted_via,
    CASE WHEN l_suppkey % 31 = 0 THEN '' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date_sent_to_company,
    {sql_list(RESPONSES)}[CAST(l_suppkey % 4 AS INTEGER) + 1] AS company_response_to_consumer,
    CASE WHEN p_name LIKE 'cold%' OR (l_partkey + l_linenumber) % 10 = 0 THEN 'No'
      WHEN (l_partkey + l_linenumber) % 10 = 1 THEN '' ELSE ' Yes' END AS timely_response,
    ['Yes', 'No', '', '', ''][CAST(l_suppkey % 5 AS INTEGER) + 1] AS consumer_disputed,
    CASE l_partkey % 97 WHEN 5 THEN 'x' || l_orderkey WHEN 6 THEN '' WHEN 7 THEN ' ' || l_orderkey || ' '
      ELSE CAST(l_orderkey AS VARCHAR) END AS complaint_id,
    CASE WHEN l_linenumber <= 4 THEN TIMESTAMP '{BATCHES["batch-a"]}' ELSE TIMESTAMP '{BATCHES["batch-b"]}' END AS _ingested_at,
    CASE WHEN l_linenumber <= 4 THEN 'batch-a.csv' ELSE 'batch-b.csv' END AS _source_file,
    CASE WHEN l_linenumber <= 4 THEN 'batch-a' ELSE 'batch-b' END AS _batch_id
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
    JOIN customer ON c_custkey = o_custkey)"""

_CASTS = {"date": "DATE", "bigint": "BIGINT"}
TYPED_SQL = (
    RAW_SQL
    + ",\ncomplaints AS (SELECT "
    + ", ".join(
        f"TRY_CAST(trim({name}) AS {_CASTS[kind]}) AS {name}" if kind in _CASTS else name
        for name, (_, kind) in COMPLAINT_TARGETS.items()
    )
    + " FROM raw)"
)
