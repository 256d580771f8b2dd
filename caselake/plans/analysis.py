"""Business questions on the typed complaints table (K-Q2, K-Q3)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.functions.columns import days_between, month_of, pct
from caselake.operators.aggregates import (
    count_by, count_by_month, exact_percentiles, moving_average, period_over_period, running_total,
    share_of_total, top_n_per_group, weighted_mean,
)


def between_days(df: DataFrame, day: str, first: date, end: date) -> DataFrame:
    """Half-open range on the bare column, so that it reaches the scan."""
    return df.filter((F.col(day) >= F.lit(first)) & (F.col(day) < F.lit(end)))


def q1_per_product_and_month(complaints: DataFrame) -> DataFrame:
    return count_by_month(complaints, "product", "date_received", "complaints").orderBy(
        F.desc("month"), F.desc("complaints"), "product"
    )


def q2_month_over_month(complaints: DataFrame) -> DataFrame:
    return month_over_month(count_by_month(complaints, "product", "date_received"))


def month_over_month(monthly: DataFrame) -> DataFrame:
    """From the raw table or from a summary table (A13): the same question."""
    return period_over_period(monthly, "product", "month", "n").orderBy(F.desc("month"), F.desc("n"), "product")


def q3_top_issues_of_top_companies(complaints: DataFrame, companies: int = 10, issues: int = 5) -> DataFrame:
    """Counting per (company, issue) once serves both rankings; rows are never joined back."""
    counted = count_by(complaints, "company", "issue")
    top = (
        counted.groupBy("company")
        .agg(F.sum("n").alias("_total"))
        .orderBy(F.desc("_total"), F.asc_nulls_last("company"))
        .limit(companies)
        .select("company")
    )
    # at most ``companies`` rows, so the broadcast has a fixed bound
    ranked = top_n_per_group(counted.join(F.broadcast(top), "company"), ["company"], "n", issues)
    return ranked.select("company", "rnk", "issue", "n").orderBy("company", "rnk", "issue")


def q4_running_total(complaints: DataFrame, first: date, end: date) -> DataFrame:
    daily = count_by(between_days(complaints, "date_received", first, end), "product", F.col("date_received").alias("d"))
    return running_total(daily, "product", "d", "n").orderBy("product", "d")


def q5_late_responders(complaints: DataFrame, min_complaints: int = 500, k: int = 20) -> DataFrame:
    late = F.count_if(F.col("timely_response") == "No")
    rates = complaints.groupBy("company").agg(
        F.count("*").alias("complaints"), late.alias("late"), pct(late, F.count("*")).alias("late_pct")
    )
    # HAVING; the company name settles ties at the cut
    return (
        rates.filter(F.col("complaints") >= min_complaints)
        .orderBy(F.desc("late_pct"), F.desc("complaints"), F.asc_nulls_last("company"))
        .limit(k)
    )


def q6_share_of_month(complaints: DataFrame) -> DataFrame:
    monthly = count_by_month(complaints, "product", "date_received").select("month", "product", "n")
    return share_of_total(monthly, ["month"], "n", "pct_of_month").orderBy(
        F.desc("month"), F.desc("pct_of_month"), "product"
    )


def q7_moving_average(complaints: DataFrame, product: str) -> DataFrame:
    monthly = complaints.filter(F.col("product") == product).groupBy(month_of("date_received").alias("month")).agg(
        F.count("*").alias("n")
    )
    return moving_average(monthly, "month", "n", 3, "ma_3m").orderBy(F.desc("month"))


def q8_forwarding_days(complaints: DataFrame) -> DataFrame:
    days = complaints.select(
        "submitted_via", days_between("date_received", "date_sent_to_company").alias("days")
    )
    stats = exact_percentiles(
        days, ["submitted_via"], "days", {"median_days": 0.5, "p95_days": 0.95}, ("avg_days", weighted_mean("days")), few_values=True
    )
    return stats.select("submitted_via", "n", "avg_days", "median_days", "p95_days").orderBy(
        F.desc("n"), "submitted_via"
    )


def p1_by_id(complaints: DataFrame, complaint_id: int) -> DataFrame:
    return complaints.filter(F.col("complaint_id") == complaint_id)


def p2_issues_of_company(complaints: DataFrame, company: str, first: date, end: date) -> DataFrame:
    rows = between_days(complaints.filter(F.col("company") == company), "date_received", first, end)
    return count_by(rows, "issue").orderBy(F.desc("n"), "issue")


def p3a_one_day_formatted(complaints: DataFrame, day: date) -> DataFrame:
    """The predicate wraps the column in a function: no file or row group can be skipped."""
    return complaints.filter(F.date_format("date_received", "yyyy-MM-dd") == day.isoformat()).agg(
        F.count("*").alias("n")
    )


def p3b_one_day(complaints: DataFrame, day: date) -> DataFrame:
    """The same question on the bare column: pushed down to the Parquet scan."""
    return complaints.filter(F.col("date_received") == F.lit(day)).agg(F.count("*").alias("n"))
