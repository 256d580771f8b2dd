"""The data-quality report (L14): every number is a small DataFrame, only final rows are collected."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.functions.columns import safe_date, safe_long
from caselake.operators.aggregates import joined_text, null_percentages
from caselake.operators.checks import Result, recent_rows
from caselake.plans.gold import flag_summary
from caselake.session import side_by_side

# Completeness line -> Silver column.
COMPLETENESS = {
    "company": "company",
    "state (valid)": "state",
    "date_sent_to_company": "date_sent_to_company",
    "is_timely": "is_timely",
    "is_disputed": "is_disputed",
    "narrative": "narrative",
    "zip_code": "zip_code",
}


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of every layer, rejected rows and removed copies in one line."""
    bronze, silver = tables["bronze"], tables["silver"]
    bad_id, bad_date = safe_long("complaint_id").isNull(), safe_date("date_received").isNull()
    kept = silver.select(F.count("*")).scalar()
    return bronze.agg(
        F.count("*").alias("bronze"), F.count_if(bad_id | bad_date).alias("rejects"), kept.alias("silver")
    ).withColumn("duplicates_removed", F.col("bronze") - F.col("rejects") - F.col("silver"))


def repeated_ids(bronze: DataFrame) -> DataFrame:
    """How many usable ids occur more than once in Bronze."""
    usable = bronze.select(safe_long("complaint_id").alias("id"), safe_date("date_received").alias("day"))
    per_id = usable.filter("id IS NOT NULL AND day IS NOT NULL").groupBy("id").agg(F.count("*").alias("n"))
    return per_id.agg(F.count_if(F.col("n") > 1).alias("repeated_ids"))


def reject_reasons(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reject_reason").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "reject_reason")


def completeness(silver: DataFrame) -> DataFrame:
    return null_percentages(silver, COMPLETENESS)


def invalid_states(silver: DataFrame, k: int = 15) -> DataFrame:
    bad = silver.filter("dq_invalid_state").groupBy("state_raw").agg(F.count("*").alias("rows"))
    return bad.orderBy(F.desc("rows"), "state_raw").limit(k)


def standardisation(silver: DataFrame, lookup: DataFrame, product_map: DataFrame) -> DataFrame:
    """Spellings, companies, seed-mapped spellings, renamed issues and unmapped products in one line."""
    products = silver.groupBy("product").agg(F.count_if(F.col("issue") != F.col("issue_raw")).alias("renamed"))
    listed = product_map.select("product", F.lit(True).alias("_listed"))
    names = lookup.agg(
        F.count("*").alias("raw_names"),
        F.count_distinct("company").alias("companies"),
        F.count_if("mapped_by_seed").alias("seed_mapped"),
    )
    found = products.join(listed, "product", "left").agg(
        F.coalesce(F.sum("renamed"), F.lit(0)).cast("bigint").alias("issues_renamed"),
        F.count_if(F.col("_listed").isNull() & F.col("product").isNotNull()).alias("products_unmapped"),
    )
    return names.withColumns(
        {name: found.select(name).scalar() for name in ["issues_renamed", "products_unmapped"]}
    )


def loaded_batches(log: DataFrame) -> DataFrame:
    """All batches of the last load, put together by what their headers lacked or added."""
    last = log.select(F.max("ingested_at")).scalar()
    return (
        log.filter(F.col("ingested_at") == last)
        .groupBy("missing_columns", "extra_columns")
        .agg(F.count("*").alias("files"), F.sum("row_count").alias("rows"), F.min("source_file").alias("first_file"), F.max("source_file").alias("last_file"))
        .orderBy("missing_columns", "extra_columns")
    )


def largest_companies(scorecard: DataFrame, lookup: DataFrame, k: int = 20) -> DataFrame:
    big = scorecard.orderBy(F.desc("complaints"), "company").limit(k).select("company", "complaints", "raw_name_variants")
    # at most k companies: only their spellings are gathered
    theirs = lookup.join(F.broadcast(big.select("company")), "company", "left_semi")
    spelled = theirs.groupBy("company").agg(joined_text("company_raw").alias("raw_spellings"))
    return big.join(spelled, "company").orderBy(F.desc("complaints"), "company")


def all_late_companies(scorecard: DataFrame) -> DataFrame:
    flagged = scorecard.filter("dq_check_all_late").select("company", "complaints", "late_responses", "late_pct")
    return flagged.orderBy(F.desc("complaints"), "company")


def markdown(df: DataFrame) -> str:
    """A small result as a Markdown table."""

    def cell(value) -> str:
        if value is None:
            return ""
        return f"{value:,}" if isinstance(value, int) and not isinstance(value, bool) else str(value)

    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    lines += ["| " + " | ".join(cell(v) for v in row) + " |" for row in df.collect()]
    return "\n".join(lines)


def build_report(
    tables: dict[str, DataFrame],
    product_map: DataFrame,
    checks: list[Result],
    timings: dict[str, float],
    generated: datetime,
) -> str:
    """Markdown text. ``tables``: bronze, log, rejects, lookup, silver and the four Gold tables."""
    silver, lookup, scorecard = tables["silver"], tables["lookup"], tables["company_scorecard"]
    gold = ["monthly_product_stats", "company_scorecard", "company_top_issues", "channel_forwarding_stats"]
    sections = {
        "Row counts per layer": lambda: markdown(layer_counts(tables)),
        "Ids that occurred more than once": lambda: markdown(repeated_ids(tables["bronze"])),
        "Gold tables": lambda: markdown(_sizes({name: tables[name] for name in gold})),
        "Rejected rows by reason": lambda: markdown(reject_reasons(tables["rejects"])),
        "Source files": lambda: markdown(loaded_batches(tables["log"])),
        "Completeness (Silver)": lambda: markdown(completeness(silver)),
        "Flagged rows (kept, not deleted)": lambda: markdown(flag_summary(silver)),
        "Invalid state codes": lambda: markdown(invalid_states(silver)),
        "Standardisation": lambda: markdown(standardisation(silver, lookup, product_map)),
        "Largest companies after cleaning": lambda: markdown(largest_companies(scorecard, lookup)),
        "Companies late on nearly everything": lambda: markdown(all_late_companies(scorecard)),
        "Freshness": lambda: markdown(recent_rows(silver)),
    }
    texts = side_by_side(sections)
    lines = ["# Data quality report", "", f"Generated {generated:%Y-%m-%d %H:%M}.", "", "## Checks", ""]
    lines += ["| Check | Severity | Bad rows | Result |", "|---|---|---|---|"]
    lines += [f"| {r.name} | {r.severity} | {r.bad_rows:,} | {'PASS' if r.passed else 'FAIL'} |" for r in checks]
    for title, text in texts.items():
        lines += ["", f"## {title}", "", text]
    lines += ["", "## Step timings", "", "| Step | Seconds |", "|---|---|"]
    lines += [f"| {step} | {seconds:.1f} |" for step, seconds in timings.items()]
    return "\n".join(lines) + "\n"


def _sizes(tables: dict[str, DataFrame]) -> DataFrame:
    result = None
    for name, df in tables.items():
        part = df.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows"))
        result = part if result is None else result.unionByName(part)
    return result
