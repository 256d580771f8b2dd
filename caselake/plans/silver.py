"""Silver: typed, standardised, deduplicated rows and the quarantine (J5-J7, K-S1..K-S5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.functions.columns import clean_text, days_between, safe_date, safe_long, trim_spaces, yes_no
from caselake.functions.names import clean_company_text, company_base, legal_form
from caselake.operators.joins import apply_map, lookup_join, resolve_state
from caselake.operators.numbering import latest_per_key, total_order
from caselake.session import materialise

REJECT_REASONS = ["invalid complaint_id", "invalid date_received"]


def stage(bronze: DataFrame) -> DataFrame:
    """Typed and trimmed Bronze rows, one to one (K-S1)."""
    return bronze.select(
        safe_long("complaint_id").alias("complaint_id"),
        trim_spaces("complaint_id").alias("complaint_id_raw"),
        safe_date("date_received").alias("date_received"),
        safe_date("date_sent_to_company").alias("date_sent_to_company"),
        clean_text("product", "Unknown").alias("product"),
        clean_text("sub_product", "N/A").alias("sub_product"),
        clean_text("issue", "Unknown").alias("issue_raw"),
        clean_text("sub_issue", "N/A").alias("sub_issue"),
        clean_text("consumer_complaint_narrative").alias("narrative"),
        clean_text("company").alias("company_raw"),
        F.upper(clean_text("state")).alias("state_raw"),
        clean_text("zip_code").alias("zip_code"),
        clean_text("submitted_via", "Unknown").alias("submitted_via"),
        clean_text("company_response_to_consumer", "Unknown").alias("company_response"),
        yes_no("timely_response").alias("is_timely"),
        yes_no("consumer_disputed").alias("is_disputed"),
        "_ingested_at",
        "_batch_id",
    )


def usable(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("complaint_id").isNotNull() & F.col("date_received").isNotNull())


def rejects(bronze: DataFrame) -> DataFrame:
    """Rows without a usable id or date, every original value kept, with the reason (K-S2)."""
    bad_id, bad_date = safe_long("complaint_id").isNull(), safe_date("date_received").isNull()
    id_reason, date_reason = REJECT_REASONS
    return bronze.filter(bad_id | bad_date).withColumn(
        "reject_reason", F.when(bad_id, F.lit(id_reason)).otherwise(F.lit(date_reason))
    )


def keep_latest(rows: DataFrame, tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """One row per complaint: latest sent date (missing last), then latest ingest (K-S3)."""
    latest = [F.col("date_sent_to_company").desc_nulls_last(), F.col("_ingested_at").desc_nulls_last()]
    order = (
        total_order(rows, latest)
        if tie_breakers is None
        else [*latest, *[F.col(c).asc_nulls_last() for c in tie_breakers]]
    )
    return latest_per_key(rows, ["complaint_id"], order)


def company_names(staged: DataFrame) -> DataFrame:
    """The distinct raw spellings: all name rules work on these, not on the rows."""
    return staged.select("company_raw").filter(F.col("company_raw").isNotNull()).distinct()


def company_lookup(names: DataFrame, company_map: DataFrame) -> DataFrame:
    """Raw spelling -> company.

    Spellings of one base merge while they show at most one legal form. Whether a base has
    several forms is seen from the smallest and largest form, which aggregate before the shuffle.
    """
    cleaned = names.select("company_raw", clean_company_text("company_raw").alias("_cleaned"))
    based = cleaned.withColumn("company_base", company_base("_cleaned"))
    formed = based.select("company_raw", "company_base", legal_form("_cleaned", "company_base").alias("legal_form"))
    known_form = F.nullif("legal_form", F.lit(""))
    mixed = (
        formed.groupBy("company_base")
        .agg((F.min(known_form) != F.max(known_form)).alias("_mixed_forms"))
        .filter("_mixed_forms")
    )
    reviewed = company_map.select(F.col("company_norm").alias("company_base"), "company_canonical")
    automatic = F.when(
        F.col("_mixed_forms"), F.concat("company_base", F.lit(" "), F.col("legal_form"))
    ).otherwise(F.nullif("company_base", F.lit("")))
    marked = lookup_join(formed, materialise(mixed, "mixed_bases"), ["company_base"])
    return lookup_join(marked, reviewed, ["company_base"]).select(
        "company_raw",
        F.coalesce("company_canonical", automatic, F.upper("company_raw")).alias("company"),
        "company_base",
        "legal_form",
        F.col("company_canonical").isNotNull().alias("mapped_by_seed"),
    )


def enrich(rows: DataFrame, lookup: DataFrame, seeds: dict[str, DataFrame]) -> DataFrame:
    """Product group, current issue wording, company, state and region."""
    grouped = apply_map(rows, seeds["product_map"], "product", "product", "product_group", "product_group")
    worded = apply_map(grouped, seeds["issue_map"], "issue_raw", "issue_raw", "issue_clean", "issue")
    named = lookup_join(worded, lookup.select("company_raw", "company"), ["company_raw"])
    return resolve_state(named, seeds["state_ref"], seeds["state_alias"])


def quality_flags(rows: DataFrame) -> DataFrame:
    """Problems are marked, not deleted (K-S4)."""
    sent, received = F.col("date_sent_to_company"), F.col("date_received")
    return rows.withColumns(
        {
            "days_to_send": days_between(received, sent),
            "dq_sent_before_received": sent.isNotNull() & (sent < received),
            "dq_invalid_state": F.col("state_raw").isNotNull() & F.col("state").isNull(),
            "dq_future_date": received > F.col("_ingested_at").cast("date"),
        }
    )


SILVER_COLUMNS = [
    "complaint_id", "date_received", "date_sent_to_company", "product", "sub_product", "issue_raw", "sub_issue",
    "narrative", "company_raw", "state_raw", "zip_code", "submitted_via", "company_response", "is_timely",
    "is_disputed", "_ingested_at", "_batch_id", "product_group", "issue", "company", "state", "region",
    "days_to_send", "dq_sent_before_received", "dq_invalid_state", "dq_future_date",
]


def build_company_lookup(bronze: DataFrame, seeds: dict[str, DataFrame], write=None) -> DataFrame:
    """The lookup as a written table: computed once, of known size for the join that follows."""
    spellings = company_names(bronze.select(clean_text("company").alias("company_raw")))
    # written before the rules run: Catalyst would otherwise move a filter on their result below
    # the distinct, and so apply every rule to every row
    names = materialise(spellings, "company_names")
    lookup = company_lookup(names, seeds["company_map"])
    return write(lookup) if write else materialise(lookup, "company_lookup")


def build_silver(bronze: DataFrame, lookup: DataFrame, seeds: dict[str, DataFrame]) -> DataFrame:
    """Typed -> deduplicated -> enriched -> flagged (K-S5).

    The copies are dropped before the lookups: the result is the same, because every lookup has
    one row per key, and the only wide shuffle carries no enriched columns.
    """
    kept = keep_latest(usable(stage(bronze)).drop("complaint_id_raw"))
    return quality_flags(enrich(kept, lookup, seeds)).select(*SILVER_COLUMNS)
