"""Gold: small business tables built only from Silver (K-G1..K-G4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.functions.columns import month_of, pct, round_half, safe_long
from caselake.operators.aggregates import (
    exact_percentiles, first_and_last_seen, joined_text, top_n_per_group, weighted_mean,
)
from caselake.operators.joins import in_either
from caselake.session import materialise

# A company this large and this late is checked before it is reported.
ALL_LATE_MIN_COMPLAINTS, ALL_LATE_PERCENT = 500, 99


def monthly_product_stats(silver: DataFrame) -> DataFrame:
    """Volume and timeliness per month and product group, the running month marked (K-G1)."""
    last_day = silver.filter(~F.col("dq_future_date")).select(F.max("date_received")).scalar()
    per_month = silver.groupBy(month_of("date_received").alias("month"), "product_group").agg(
        F.count("*").alias("complaints"),
        F.count_if(~F.col("is_timely")).alias("late_responses"),
        F.count("is_timely").alias("responses_known"),
        pct(F.count_if("is_timely"), F.count("is_timely")).alias("timely_pct"),
    )
    return per_month.withColumn("is_partial_month", F.col("month") == month_of(last_day))


def company_scorecard(silver: DataFrame, min_complaints: int = ALL_LATE_MIN_COMPLAINTS) -> DataFrame:
    """One row per company (K-G2). The parts of every rate are kept, so roll-ups stay right.

    Rows are added up per (company, spelling, product group) first. The two distinct counts then
    work on those few combinations; a company with most of the rows costs no more than others.
    """
    parts = (
        silver.filter(F.col("company").isNotNull())
        .groupBy("company", "company_raw", "product_group")
        .agg(
            F.count("*").alias("n"),
            F.count_if(~F.col("is_timely")).alias("late"),
            F.count("is_timely").alias("known"),
            F.sum("days_to_send").alias("days"),
            F.count("days_to_send").alias("days_known"),
            F.min("date_received").alias("first_day"),
            F.max("date_received").alias("last_day"),
        )
    )
    total, late, known = F.sum("n"), F.sum("late"), F.sum("known")
    mean_days = F.sum("days").cast("double") / F.nullif(F.sum("days_known").cast("double"), F.lit(0.0))
    return parts.groupBy("company").agg(
        total.alias("complaints"),
        F.count_distinct("company_raw").alias("raw_name_variants"),
        F.count_distinct("product_group").alias("product_groups"),
        late.alias("late_responses"),
        known.alias("responses_known"),
        pct(late, known).alias("late_pct"),
        round_half(mean_days, 2).alias("avg_days_to_send"),
        F.min("first_day").alias("first_complaint"),
        F.max("last_day").alias("last_complaint"),
        # whole numbers, so the threshold is exact; nothing known counts as all late
        ((total >= min_complaints) & (late * 100 >= known * ALL_LATE_PERCENT)).alias("dq_check_all_late"),
    )


def company_top_issues(silver: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent issues per company, ties kept (K-G3)."""
    counted = (
        silver.filter(F.col("company").isNotNull()).groupBy("company", "issue").agg(F.count("*").alias("complaints"))
    )
    return top_n_per_group(counted, ["company"], "complaints", n, "issue_rank")


def channel_forwarding_stats(silver: DataFrame) -> DataFrame:
    """How long forwarding takes per channel, with exact percentiles (K-G4)."""
    stats = exact_percentiles(
        silver.filter(F.col("days_to_send").isNotNull()),
        ["submitted_via"],
        "days_to_send",
        {"median_days": 0.5, "p95_days": 0.95},
        ("avg_days", weighted_mean("days_to_send")),
        # sent before received is the same as a negative number of days
        ("sent_before_received", F.sum(F.when(F.col("days_to_send") < 0, F.col("_n")).otherwise(0)).cast("bigint")),
        few_values=True,  # days
    )
    return stats.select(
        "submitted_via", F.col("n").alias("complaints"), "avg_days", "median_days", "p95_days", "sent_before_received"
    )


GOLD_TABLES = {
    "monthly_product_stats": monthly_product_stats,
    "company_scorecard": company_scorecard,
    "company_top_issues": company_top_issues,
    "channel_forwarding_stats": channel_forwarding_stats,
}


def build_gold(silver: DataFrame) -> dict[str, DataFrame]:
    return {name: build(silver) for name, build in GOLD_TABLES.items()}


# ---- questions asked of Silver and Gold --------------------------------------------------------


def flag_summary(silver: DataFrame) -> DataFrame:
    """How many rows carry each quality flag."""
    return silver.agg(
        F.count_if("dq_sent_before_received").alias("sent_before_received"),
        F.count_if("dq_invalid_state").alias("invalid_state"),
        F.count_if("dq_future_date").alias("future_date"),
        F.count("*").alias("all_rows"),
    )


def merge_review(scorecard: DataFrame, lookup: DataFrame) -> DataFrame:
    """Companies made of more than one spelling, with the spellings."""
    wanted = scorecard.filter(F.col("raw_name_variants") > 1).select("company", "complaints", "raw_name_variants")
    theirs = lookup.select("company", "company_raw").join(wanted.select("company"), "company", "left_semi")
    spelled = theirs.groupBy("company").agg(joined_text("company_raw").alias("raw_spellings"))
    merged = wanted.join(spelled, "company")
    return merged.select("company", "complaints", "raw_name_variants", "raw_spellings").orderBy(
        F.desc("complaints"), "company"
    )


def spellings_of_big_companies(scorecard: DataFrame, lookup: DataFrame, k: int = 15) -> DataFrame:
    """Every raw spelling of the ``k`` largest companies."""
    big = scorecard.orderBy(F.desc("complaints"), "company").limit(k).select("company")
    return (
        lookup.join(F.broadcast(big), "company", "left_semi")  # at most k rows
        .groupBy("company")
        .agg(F.count("*").alias("raw_spellings"), joined_text("company_raw").alias("spellings"))
        .orderBy(F.desc("raw_spellings"), "company")
    )


def issue_rename_evidence(silver: DataFrame, issue_map: DataFrame) -> DataFrame:
    """An old wording should stop about when the new one starts (D14). Grouped before the lookup."""
    seen = first_and_last_seen(silver, ["issue_raw", "issue"], "date_received")
    renamed = in_either(seen, "issue_raw", issue_map.select("issue_raw"), "issue", issue_map.select("issue_clean"))
    return renamed.withColumnRenamed("issue", "mapped_to").orderBy("mapped_to", "first_seen")


def latest_months(monthly: DataFrame, k: int = 4) -> DataFrame:
    """The running month is marked, so trend charts can leave it out."""
    return (
        monthly.groupBy("month")
        .agg(F.sum("complaints").cast("bigint").alias("complaints"), F.bool_or("is_partial_month").alias("is_partial_month"))
        .orderBy(F.desc("month"))
        .limit(k)
    )


def late_responders_from_silver(silver: DataFrame, min_complaints: int = 500, k: int = 10) -> DataFrame:
    rates = (
        silver.filter(F.col("company").isNotNull())
        .groupBy("company")
        .agg(
            F.count("*").alias("complaints"),
            pct(F.count_if(~F.col("is_timely")), F.count("is_timely")).alias("late_pct"),
        )
    )
    return _latest_first(rates, min_complaints, k)


def late_responders_from_gold(scorecard: DataFrame, min_complaints: int = 500, k: int = 10) -> DataFrame:
    return _latest_first(scorecard.select("company", "complaints", "late_pct"), min_complaints, k)


def _latest_first(rates: DataFrame, min_complaints: int, k: int) -> DataFrame:
    return (
        rates.filter(F.col("complaints") >= min_complaints)
        .orderBy(F.desc_nulls_last("late_pct"), F.desc("complaints"), "company")
        .limit(k)
    )


def channel_days_from_silver(silver: DataFrame) -> DataFrame:
    return channel_days_from_gold(channel_forwarding_stats(silver))


def channel_days_from_gold(channels: DataFrame) -> DataFrame:
    return channels.select("submitted_via", "complaints", "median_days", "p95_days").orderBy(F.desc("complaints"))


def lineage(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """The Bronze rows of one renamed complaint next to its Silver row (K-Q4)."""
    example = silver.filter(F.col("issue") != F.col("issue_raw")).select(F.min("complaint_id")).scalar()
    columns = ["complaint_id", "company", "issue", "state", "timely_response", "date_received"]
    raw = bronze.filter(safe_long("complaint_id") == example).select(F.lit("bronze").alias("layer"), *columns)
    clean = silver.withColumn("timely_response", F.col("is_timely")).filter(F.col("complaint_id") == example)
    return raw.unionByName(
        clean.select(F.lit("silver").alias("layer"), *[F.col(c).cast("string").alias(c) for c in columns])
    )


def duplicate_audit(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Ids that occur more than once, every copy's sent date and the one that was kept (K-Q5, C14).

    Copies are counted per (id, sent date) first, so a hot id is a few rows in the join with Silver;
    each count is turned back into its rows at the end.
    """
    per_date = bronze.groupBy("complaint_id", F.col("date_sent_to_company").alias("bronze_date_sent")).agg(F.count("*").alias("_n"))
    per_date = materialise(per_date, "sent_dates")
    repeated = per_date.groupBy("complaint_id").agg(F.sum("_n").alias("_all")).filter("_all > 1").withColumn("_id", safe_long("complaint_id"))
    kept = silver.select(F.col("complaint_id").alias("_id"), F.col("date_sent_to_company").alias("silver_kept_date_sent"))
    known = repeated.filter("_id IS NOT NULL").join(kept, "_id", "left").select("complaint_id", "silver_kept_date_sent")
    rows = per_date.join(known, "complaint_id").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    return rows.select("complaint_id", "bronze_date_sent", "silver_kept_date_sent")
