"""Case-history questions on case, status history and code tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.functions.columns import fit_width, hour_boundaries, starts_with
from caselake.operators.aggregates import reproducible_sample
from caselake.operators.joins import lookup_join
from caselake.operators.numbering import global_rank, latest_per_key
from caselake.sources.relations import inline_relation

MAX_ROWS = 500
# Sort key a caller may name -> column.
SORT_COLUMNS = {"date": "RCV_DT", "company": "CO_NM", "complaint": "CMPL_ID"}
# Status codes.
STATUS_CODES = [
    ("OPN", "Open"),
    ("INV", "Under investigation"),
    ("ESC", "Escalated"),
    ("LGL", "Legal hold"),
    ("CLS", "Closed"),
]
ESCALATED = ["ESC", "LGL"]
# Widths of the case table's text columns.
EXTRACT_WIDTHS = {"PRD_DESC": 100, "ISS_DESC": 255, "CO_NM": 255, "ST_CD": 2, "CHNL": 30, "NARR_TXT": 4000}


def clamp(limit: int) -> int:
    return max(1, min(int(limit), MAX_ROWS))


def status_codes(spark: SparkSession) -> DataFrame:
    return inline_relation(spark, STATUS_CODES, "STAT_CD STRING, STAT_DESC STRING")


def latest_status(history: DataFrame) -> DataFrame:
    """The last status row of every case."""
    return latest_per_key(history, ["CASE_ID"], [F.desc("UPD_TS"), F.desc("STAT_ID")])


def with_current_flag(history: DataFrame) -> DataFrame:
    """Mark the last row of every case with CUR_FLG = 1 (K8).

    The last rows are found per map task first and joined back on the row id, which is unique,
    so a case with most of the history is spread like any other rows.
    """
    last = latest_status(history).select("STAT_ID", F.lit(1).alias("CUR_FLG"))
    return history.join(last, "STAT_ID", "left").withColumn("CUR_FLG", F.coalesce("CUR_FLG", F.lit(0)))


def _current(cases: DataFrame, history: DataFrame) -> DataFrame:
    # one current row per case: joining it to the case never multiplies rows
    return cases.join(history.filter("CUR_FLG = 1").drop("CUR_FLG"), "CASE_ID")


def current_status(cases: DataFrame, history: DataFrame, codes: DataFrame, complaint_id: int) -> DataFrame:
    """Current status of one case (K1)."""
    found = _current(cases.filter(F.col("CMPL_ID") == complaint_id), history)
    return found.join(codes, "STAT_CD").select(
        "CMPL_ID", "CO_NM", "PRD_DESC", "ISS_DESC", "RCV_DT", "STAT_CD", "STAT_DESC", "ASGN_TEAM", "UPD_TS"
    )


def case_history(cases: DataFrame, history: DataFrame, codes: DataFrame, complaint_id: int) -> DataFrame:
    """Every status change of one case, oldest first (K2)."""
    case = cases.filter(F.col("CMPL_ID") == complaint_id).select("CASE_ID")
    return (
        lookup_join(history, case, ["CASE_ID"], "inner")
        .join(codes, "STAT_CD")
        .orderBy("UPD_TS", "STAT_ID")
        .select("UPD_TS", "STAT_CD", "STAT_DESC", "ASGN_TEAM", "CUR_FLG")
    )


def escalated_cases(
    cases: DataFrame,
    history: DataFrame,
    company: str,
    since: date,
    limit: int = 50,
    sort: str = "date",
    ignore_case: bool = False,
) -> DataFrame:
    """Cases now escalated or on legal hold whose company starts with ``company`` (K3).

    The prefix is a value, never a pattern or code; the sort column comes from an allow-list
    (KeyError otherwise); the row limit stays within 1..500 (B10, B13).
    """
    column = SORT_COLUMNS[sort]
    wanted = cases.filter(starts_with("CO_NM", company, ignore_case) & (F.col("RCV_DT") >= F.lit(since)))
    return (
        _current(wanted, history.filter(F.col("STAT_CD").isin(*ESCALATED)))
        .select("CMPL_ID", "CO_NM", "RCV_DT", "ISS_DESC", "STAT_CD", "ASGN_TEAM")
        .orderBy(F.desc(column), "CMPL_ID")
        .limit(clamp(limit))
    )


def escalated_cases_sql(
    spark: SparkSession, cases_view: str, history_view: str, company: str, since: date, limit: int = 50
) -> DataFrame:
    """The same question as SQL text with bound parameters (B13): values never become code."""
    return spark.sql(
        f"""SELECT CMPL_ID, CO_NM, RCV_DT, ISS_DESC, STAT_CD, ASGN_TEAM
            FROM {cases_view} JOIN {history_view} USING (CASE_ID)
            WHERE CUR_FLG = 1 AND STAT_CD IN ('ESC', 'LGL') AND startswith(CO_NM, :company) AND RCV_DT >= :since
            ORDER BY RCV_DT DESC, CMPL_ID LIMIT :lim""",
        args={"company": company, "since": since, "lim": clamp(limit)},
    )


def status_counts(
    cases: DataFrame, history: DataFrame, codes: DataFrame, company: str | None = None, ignore_case: bool = False
) -> DataFrame:
    """Number of cases per current status, for all companies or one prefix (K4)."""
    if company:
        cases = cases.filter(starts_with("CO_NM", company, ignore_case))
    counted = _current(cases.select("CASE_ID"), history).groupBy("STAT_CD").agg(F.count("*").alias("cases"))
    return counted.join(codes, "STAT_CD").select("STAT_CD", "STAT_DESC", "cases").orderBy(F.desc("cases"), "STAT_CD")


def cases_now(cases: DataFrame, history: DataFrame, company: str, status: str) -> DataFrame:
    """How many cases of a company prefix are in one status now."""
    wanted = cases.filter(starts_with("CO_NM", company)).select("CASE_ID")
    return _current(wanted, history.filter(F.col("STAT_CD") == status)).agg(F.count("*").alias("cases_now"))


def code_usage(history: DataFrame, codes: DataFrame) -> DataFrame:
    """Every code with its current cases and all its history rows, zero included (K5)."""
    used = history.groupBy("STAT_CD").agg(F.count_if(F.col("CUR_FLG") == 1).alias("c"), F.count("*").alias("h"))
    return codes.join(used, "STAT_CD", "left").select(
        "STAT_CD",
        "STAT_DESC",
        F.coalesce("c", F.lit(0)).alias("current_cases"),
        F.coalesce("h", F.lit(0)).alias("all_history_rows"),
    ).orderBy(F.desc("current_cases"), "STAT_CD")


def status_rows_and_cases(history: DataFrame, status: str) -> DataFrame:
    """History rows in a status next to cases that are in it now (K5)."""
    hit = F.col("STAT_CD") == status
    return history.agg(
        F.count_if(hit).alias("rows_all_history"), F.count_if(hit & (F.col("CUR_FLG") == 1)).alias("cases_now")
    )


def ever_in_status(cases: DataFrame, history: DataFrame, status: str, first: date, end: date) -> DataFrame:
    """Distinct cases per product that were ever in a status, received in [first, end) (K6)."""
    ever = history.filter(F.col("STAT_CD") == status).select("CASE_ID").distinct()
    received = cases.filter((F.col("RCV_DT") >= F.lit(first)) & (F.col("RCV_DT") < F.lit(end)))
    return (
        received.join(ever, "CASE_ID", "left_semi")
        .groupBy("PRD_DESC")
        .agg(F.count_distinct("CASE_ID").alias("cases_ever"))
        .orderBy(F.desc("cases_ever"), "PRD_DESC")
    )


def longest_waiting(cases: DataFrame, history: DataFrame, now: datetime, k: int = 20) -> DataFrame:
    """Open cases by days since their last change (K7)."""
    is_open = history.filter(F.col("STAT_CD") != "CLS")
    waiting = F.datediff(F.lit(now).cast("timestamp"), F.col("UPD_TS")).cast("bigint")
    return (
        _current(cases, is_open)
        .select("CMPL_ID", "CO_NM", "STAT_CD", "UPD_TS", waiting.alias("days_since_update"))
        .orderBy(F.desc("days_since_update"), "UPD_TS", "CMPL_ID")
        .limit(k)
    )


def hours_to_status(cases: DataFrame, history: DataFrame, status: str) -> DataFrame:
    """Hours from receipt to the current status, ranked over all such cases (K9)."""
    reached = _current(cases, history.filter(F.col("STAT_CD") == status))
    timed = reached.select("CMPL_ID", "STAT_CD", hour_boundaries(F.col("RCV_DT"), F.col("UPD_TS")).alias("hours_open"))
    return global_rank(timed, "hours_open", "rnk")


def not_exactly_one_current(history: DataFrame) -> DataFrame:
    """Cases without exactly one current row: an empty result is a pass."""
    return history.groupBy("CASE_ID").agg(F.sum("CUR_FLG").alias("current_rows")).filter("current_rows <> 1")


def cases_per_month(cases: DataFrame, k: int = 6) -> DataFrame:
    """The latest ``k`` months with their number of cases (H4)."""
    month = F.make_date(F.year("RCV_DT"), F.month("RCV_DT"), F.lit(1)).alias("month")
    return cases.groupBy(month).agg(F.count("*").alias("cases")).orderBy(F.desc("month")).limit(k)


def code_texts(codes: DataFrame, offset: int = 0, rows: int = 3) -> DataFrame:
    """Codes as text, one page of them."""
    return (
        codes.orderBy("STAT_CD")
        .select(
            F.concat("STAT_CD", F.lit(" = "), "STAT_DESC").alias("code_text"),
            F.concat_ws("/", "STAT_CD", "STAT_DESC").alias("plus_text"),
        )
        .offset(offset)
        .limit(rows)
    )


def case_extract(complaints: DataFrame, size: int = 50_000, seed: int = 42) -> DataFrame:
    """A reproducible sample of complaints in the layout of the case table."""
    known = complaints.filter(F.col("complaint_id").isNotNull() & F.col("date_received").isNotNull())
    sampled = reproducible_sample(known, "complaint_id", size, seed)
    sources = {
        "PRD_DESC": "product", "ISS_DESC": "issue", "CO_NM": "company", "ST_CD": "state",
        "CHNL": "submitted_via", "NARR_TXT": "consumer_complaint_narrative",
    }
    texts = [fit_width(source, EXTRACT_WIDTHS[name]).alias(name) for name, source in sources.items()]
    return sampled.select(
        F.col("complaint_id").alias("CMPL_ID"), *texts[:4], F.col("date_received").alias("RCV_DT"), *texts[4:],
        F.col("company_response_to_consumer").alias("RESP"),
    )
