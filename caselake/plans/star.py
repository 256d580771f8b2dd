"""Star schemas: dimensions with surrogate keys, facts, and the questions asked of them (K-D*, K-Q1)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.functions.columns import (
    as_column, calendar_fields, clean_text, date_key, days_between, flag_to_int, pct, product_group, yes_no,
)
from caselake.operators.aggregates import joined_text, ratio_of_sums_and_mean_of_ratios
from caselake.operators.joins import fan_out, lookup_join, orphan_count
from caselake.operators.numbering import dense_keys
from caselake.session import materialise, side_by_side
from caselake.sources.relations import calendar, inline_relation

Writer = Callable[[DataFrame, str], DataFrame]
UNKNOWN = -1
# The days covered by the date dimension, end exclusive.
CALENDAR = (date(2011, 1, 1), date(2028, 1, 1))


def source_view(complaints: DataFrame) -> DataFrame:
    """Typed complaints with defaults for missing descriptions; rows without an id are left out."""
    return complaints.filter(F.col("complaint_id").isNotNull()).select(
        "complaint_id",
        "date_received",
        F.col("date_sent_to_company").alias("date_sent"),
        clean_text("product", "Unknown").alias("product"),
        clean_text("sub_product", "N/A").alias("sub_product"),
        clean_text("issue", "Unknown").alias("issue"),
        clean_text("sub_issue", "N/A").alias("sub_issue"),
        clean_text("company").alias("company"),
        F.upper(clean_text("state")).alias("state"),
        clean_text("submitted_via", "Unknown").alias("submitted_via"),
        clean_text("company_response_to_consumer", "Unknown").alias("company_response"),
        clean_text("timely_response", "Unknown").alias("timely_response"),
        clean_text("consumer_disputed", "Not collected").alias("consumer_disputed"),
        F.col("consumer_complaint_narrative").isNotNull().alias("has_narrative"),
    )


def with_unknown(dimension: DataFrame, row: Sequence) -> DataFrame:
    """Add the -1 member that rows without a match point to."""
    return inline_relation(dimension.sparkSession, [row], dimension.schema).unionByName(dimension)


def dim_date(spark: SparkSession, first: date = CALENDAR[0], end: date = CALENDAR[1]) -> DataFrame:
    """One row per day; serves as received date and as sent date (K-D1)."""
    days = calendar(spark, first, end)
    fields = [c.alias(name) for name, c in calendar_fields("d").items()]
    described = days.select(date_key("d").alias("date_key"), F.col("d").alias("full_date"), *fields)
    unknown = (UNKNOWN, None, None, None, None, "Unknown", "Unknown", None, "Unknown", None)
    return with_unknown(described, unknown)


def _members(source: DataFrame, columns: Sequence[str], name: str, write: Writer) -> DataFrame:
    # written once: numbering counts the members before it sorts them
    return write(source.select(*columns).distinct(), f"members_{name}")


def dim_company_raw(source: DataFrame, write: Writer = materialise) -> DataFrame:
    """One row per raw company name (K-D2)."""
    members = _members(source.filter(F.col("company").isNotNull()), ["company"], "company", write)
    keyed = dense_keys(members, ["company"], "company_key")
    return with_unknown(
        keyed.select(
            "company_key", F.col("company").alias("company_name_raw"), F.upper("company").alias("company_name_clean")
        ),
        (UNKNOWN, "Unknown", "UNKNOWN"),
    )


def dim_company(lookup: DataFrame, write: Writer = materialise) -> DataFrame:
    """One row per standardised company with its spellings and legal forms (K-D2)."""
    forms = joined_text(F.nullif("legal_form", F.lit("")), ", ")
    companies = lookup.groupBy("company").agg(
        F.count("*").alias("raw_name_variants"),
        F.nullif(forms, F.lit("")).alias("legal_forms"),
        F.bool_or("mapped_by_seed").alias("mapped_by_seed"),
    )
    keyed = dense_keys(write(companies, "members_companies"), ["company"], "company_key")
    return with_unknown(keyed.withColumnRenamed("company", "company_name"), (UNKNOWN, "Unknown", 0, None, False))


def dim_product(source: DataFrame, group: Column | str | None = None, write: Writer = materialise) -> DataFrame:
    """Product and sub-product with a group that survives renames (K-D3): by rule, or ``group``."""
    group = product_group("product") if group is None else as_column(group)
    rows = source.select("product", "sub_product", group.alias("product_group"))
    members = _members(rows, rows.columns, "product", write)
    return dense_keys(members, ["product", "sub_product"], "product_key")


def dim_issue(source: DataFrame, write: Writer = materialise) -> DataFrame:
    """(K-D4)"""
    return dense_keys(_members(source, ["issue", "sub_issue"], "issue", write), ["issue", "sub_issue"], "issue_key")


def dim_state_seen(source: DataFrame, state_ref: DataFrame, write: Writer = materialise) -> DataFrame:
    """Codes seen in the data; unlisted ones are kept as 'Other code: XX' (K-D5)."""
    members = _members(source.filter(F.col("state").isNotNull()), ["state"], "state", write)
    described = lookup_join(members, state_ref.withColumnRenamed("state_code", "state"), ["state"]).select(
        F.col("state").alias("state_code"),
        F.coalesce("state_name", F.concat(F.lit("Other code: "), F.col("state"))).alias("state_name"),
        F.coalesce("region", F.lit("Unknown")).alias("region"),
    )
    return with_unknown(dense_keys(described, ["state_code"], "state_key"), (UNKNOWN, "NA", "Unknown", "Unknown"))


def dim_state(state_ref: DataFrame) -> DataFrame:
    """The reference list only (K-D5)."""
    return with_unknown(dense_keys(state_ref, ["state_code"], "state_key"), (UNKNOWN, "NA", "Unknown", "Unknown"))


RESPONSE_FLAGS = ["submitted_via", "company_response", "timely_response", "consumer_disputed"]


def dim_response(source: DataFrame, write: Writer = materialise) -> DataFrame:
    """Junk dimension: the combinations of four small flags that occur (K-D6)."""
    return dense_keys(_members(source, RESPONSE_FLAGS, "response", write), RESPONSE_FLAGS, "response_key")


def lookup_key(
    rows: DataFrame, dimension: DataFrame, key: str, on: dict[str, str], required: bool = False
) -> DataFrame:
    """Add a surrogate key (C4): -1 where nothing matches, or drop such rows if ``required``."""
    keys = dimension.filter(F.col(key) != UNKNOWN).select(key, *[F.col(d).alias(s) for s, d in on.items()])
    joined = lookup_join(rows, keys, list(on), "inner" if required else "left")
    return joined.withColumn(key, F.coalesce(key, F.lit(UNKNOWN)))


def build_star(
    complaints: DataFrame,
    state_ref: DataFrame,
    write: Writer = materialise,
    days: tuple[date, date] = CALENDAR,
) -> dict[str, DataFrame]:
    """Six dimensions and the fact of the raw star (K-D1..K-D7). Every dimension is a written
    table before the fact looks up its keys."""
    spark, source = complaints.sparkSession, source_view(complaints)
    star = side_by_side(
        {
            "dim_date": lambda: write(dim_date(spark, *days), "dim_date"),
            "dim_company": lambda: write(dim_company_raw(source, write), "dim_company"),
            "dim_product": lambda: write(dim_product(source, write=write), "dim_product"),
            "dim_issue": lambda: write(dim_issue(source, write), "dim_issue"),
            "dim_state": lambda: write(dim_state_seen(source, state_ref, write), "dim_state"),
            "dim_response": lambda: write(dim_response(source, write), "dim_response"),
        }
    )
    rows = lookup_key(source, star["dim_company"], "company_key", {"company": "company_name_raw"})
    rows = lookup_key(rows, star["dim_state"], "state_key", {"state": "state_code"})
    for name in ["product", "issue", "response"]:
        dimension = star[f"dim_{name}"]
        natural = [c for c in dimension.columns if c not in (f"{name}_key", "product_group")]
        rows = lookup_key(rows, dimension, f"{name}_key", {c: c for c in natural}, required=True)
    star["fact_complaints"] = rows.select(
        "complaint_id",
        F.coalesce(date_key("date_received"), F.lit(UNKNOWN)).alias("date_received_key"),
        F.coalesce(date_key("date_sent"), F.lit(UNKNOWN)).alias("date_sent_key"),
        "company_key",
        "product_key",
        "issue_key",
        "state_key",
        "response_key",
        F.lit(1).cast("smallint").alias("complaint_count"),
        days_between("date_received", "date_sent").cast("int").alias("days_to_send"),
        flag_to_int(yes_no("timely_response")).cast("smallint").alias("is_timely"),
        flag_to_int(yes_no("consumer_disputed")).cast("smallint").alias("is_disputed"),
        F.col("has_narrative").cast("smallint").alias("has_narrative"),
    )
    return star


def build_marts(
    silver: DataFrame,
    lookup: DataFrame,
    state_ref: DataFrame,
    write: Writer = materialise,
    days: tuple[date, date] = CALENDAR,
) -> dict[str, DataFrame]:
    """Four dimensions over Silver and a fact with degenerate issue, channel and response (K-D7)."""
    marts = side_by_side(
        {
            "dim_date": lambda: write(dim_date(silver.sparkSession, *days), "dim_date"),
            "dim_company": lambda: write(dim_company(lookup, write), "dim_company"),
            "dim_product": lambda: write(dim_product(silver, "product_group", write), "dim_product"),
            "dim_state": lambda: write(dim_state(state_ref), "dim_state"),
        }
    )
    rows = lookup_key(silver, marts["dim_company"], "company_key", {"company": "company_name"})
    products = marts["dim_product"].drop("product_group")
    rows = lookup_key(rows, products, "product_key", {"product": "product", "sub_product": "sub_product"}, True)
    rows = lookup_key(rows, marts["dim_state"].drop("region", "state_name"), "state_key", {"state": "state_code"})
    marts["fct_complaints"] = rows.select(
        "complaint_id",
        F.coalesce(date_key("date_received"), F.lit(UNKNOWN)).alias("date_received_key"),
        F.coalesce(date_key("date_sent_to_company"), F.lit(UNKNOWN)).alias("date_sent_key"),
        "company_key",
        "product_key",
        "state_key",
        "issue",
        "submitted_via",
        "company_response",
        F.lit(1).alias("complaint_count"),
        "days_to_send",
        flag_to_int("is_timely").alias("is_timely"),
        flag_to_int("is_disputed").alias("is_disputed"),
        F.col("narrative").isNotNull().cast("int").alias("has_narrative"),
        "dq_sent_before_received",
        "dq_invalid_state",
    )
    return marts


# ---- questions -------------------------------------------------------------------------------
# The fact is added up per surrogate key before a dimension is joined: every key then meets the
# dimension once, whatever share of the rows it holds.


def _summed(fact: DataFrame, *keys: str) -> DataFrame:
    return fact.groupBy(*keys).agg(
        F.sum("complaint_count").alias("complaints"),
        F.sum("is_timely").alias("timely"),
        F.count("is_timely").alias("answered"),
    )


def _on_date(rows: DataFrame, dates: DataFrame, key: str, columns: Sequence[str], prefix: str = "") -> DataFrame:
    picked = dates.select(F.col("date_key").alias(key), *[F.col(c).alias(prefix + c) for c in columns])
    return rows.join(picked, key)


def _complaints() -> Column:
    return F.sum("complaints").cast("bigint").alias("complaints")


def group_by_year(star: dict[str, DataFrame], first_year: int, last_year: int) -> DataFrame:
    rows = _summed(star["fact_complaints"], "date_received_key", "product_key")
    years = star["dim_date"].filter(F.col("year").between(first_year, last_year))
    dated = _on_date(rows, years, "date_received_key", ["year"])
    named = dated.join(star["dim_product"].select("product_key", "product_group"), "product_key")
    return named.groupBy("year", "product_group").agg(_complaints()).orderBy("year", F.desc("complaints"))


def renamed_products(star: dict[str, DataFrame]) -> DataFrame:
    """Which product wordings roll up into one group, and when each was in use."""
    rows = _summed(star["fact_complaints"], "date_received_key", "product_key")
    dated = _on_date(rows, star["dim_date"], "date_received_key", ["full_date"])
    return (
        dated.join(star["dim_product"], "product_key")
        .groupBy("product_group", "product")
        .agg(F.min("full_date").alias("first_seen"), F.max("full_date").alias("last_seen"), _complaints())
        .orderBy("product_group", "first_seen")
    )


def timely_by_region(star: dict[str, DataFrame]) -> DataFrame:
    rows = _summed(star["fact_complaints"], "state_key").join(star["dim_state"], "state_key")
    return (
        rows.groupBy("region")
        .agg(_complaints(), pct(F.sum("timely"), F.sum("answered")).alias("timely_pct"))
        .orderBy(F.desc("complaints"))
    )


def by_weekday(star: dict[str, DataFrame], year: int) -> DataFrame:
    rows = _summed(star["fact_complaints"], "date_received_key")
    days = star["dim_date"].filter(F.col("year") == year)
    dated = _on_date(rows, days, "date_received_key", ["is_weekend", "day_name", "day_of_week"])
    return (
        dated.groupBy("is_weekend", "day_name", "day_of_week")
        .agg(_complaints())
        .orderBy("day_of_week")
        .select("is_weekend", "day_name", "complaints")
    )


def received_and_sent_months(star: dict[str, DataFrame], year: int, month: int) -> DataFrame:
    """The date dimension in two roles."""
    rows = _summed(star["fact_complaints"], "date_received_key", "date_sent_key")
    received = star["dim_date"].filter((F.col("year") == year) & (F.col("month") == month))
    both = _on_date(
        _on_date(rows, received, "date_received_key", ["year_month"], "received_"),
        star["dim_date"], "date_sent_key", ["year_month"], "sent_",
    )
    return (
        both.groupBy(F.col("received_year_month").alias("received_month"), F.col("sent_year_month").alias("sent_month"))
        .agg(_complaints())
        .orderBy(F.desc("complaints"), "sent_month")
    )


def timely_rates(star: dict[str, DataFrame], year: int) -> DataFrame:
    """Ratio of sums next to the mean of the companies' ratios."""
    days = star["dim_date"].filter(F.col("year") == year).select(F.col("date_key").alias("date_received_key"))
    rows = _summed(star["fact_complaints"], "date_received_key", "company_key").join(days, "date_received_key")
    return ratio_of_sums_and_mean_of_ratios(rows, "company_key", F.col("timely"), F.col("answered"))


def product_fan_out(star: dict[str, DataFrame]) -> DataFrame:
    """Total after joining on the product name alone, which is not unique."""
    named = star["fact_complaints"].groupBy("product_key").agg(F.sum("complaint_count").alias("complaint_count"))
    with_name = named.join(star["dim_product"].select("product_key", "product"), "product_key")
    return fan_out(with_name, star["dim_product"].select("product"), "product", "complaint_count")


# ---- checks ----------------------------------------------------------------------------------
FOREIGN_KEYS = [
    ("date_received", "date_received_key", "dim_date", "date_key"),
    ("date_sent", "date_sent_key", "dim_date", "date_key"),
    ("company", "company_key", "dim_company", "company_key"),
    ("product", "product_key", "dim_product", "product_key"),
    ("issue", "issue_key", "dim_issue", "issue_key"),
    ("state", "state_key", "dim_state", "state_key"),
    ("response", "response_key", "dim_response", "response_key"),
]
NATURAL_KEYS = {
    "dim_company": ["company_name_raw"],
    "dim_product": ["product", "sub_product"],
    "dim_issue": ["issue", "sub_issue"],
    "dim_state": ["state_code"],
    "dim_response": RESPONSE_FLAGS,
    "dim_date": ["date_key"],
}


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of labelled results (G1)."""
    return reduce(DataFrame.unionByName, parts)


def grain_check(star: dict[str, DataFrame], complaints: DataFrame) -> DataFrame:
    source = complaints.filter(F.col("complaint_id").isNotNull())
    expected = source.select(F.count_distinct("complaint_id")).scalar()
    return star["fact_complaints"].agg(
        expected.alias("source_complaints"),
        F.count("*").alias("fact_rows"),
        F.count_distinct("complaint_id").alias("fact_distinct_ids"),
    ).withColumn(
        "status",
        F.when(
            (F.col("source_complaints") == F.col("fact_rows")) & (F.col("fact_rows") == F.col("fact_distinct_ids")),
            F.lit("PASS"),
        ).otherwise(F.lit("FAIL")),
    )


def orphan_check(star: dict[str, DataFrame]) -> DataFrame:
    fact = star["fact_complaints"]
    return union_all([orphan_count(fact, star[dim], fk, pk, label) for label, fk, dim, pk in FOREIGN_KEYS])


def duplicate_key_check(star: dict[str, DataFrame]) -> DataFrame:
    def check(name: str, columns: Sequence[str]) -> DataFrame:
        # a struct counts combinations with a NULL part; a single NULL key is not counted
        distinct = F.count_distinct(F.struct(*columns) if len(columns) > 1 else F.col(columns[0]))
        return star[name].agg(F.lit(name).alias("dim"), (F.count("*") - distinct).alias("duplicates"))

    return union_all([check(name, columns) for name, columns in NATURAL_KEYS.items()])


def total_check(star: dict[str, DataFrame], complaints: DataFrame) -> DataFrame:
    raw = complaints.filter(F.col("complaint_id").isNotNull()).select(F.count("*")).scalar()
    totals = star["fact_complaints"].agg(F.sum("complaint_count").cast("bigint").alias("star_total"), raw.alias("raw_total"))
    return totals.withColumn(
        "status", F.when(F.col("star_total") == F.col("raw_total"), F.lit("PASS")).otherwise(F.lit("FAIL"))
    )


def unknown_members(star: dict[str, DataFrame]) -> DataFrame:
    """How many fact rows point to the -1 member."""
    return star["fact_complaints"].agg(
        F.count_if(F.col("company_key") == UNKNOWN).alias("unknown_company"),
        F.count_if(F.col("state_key") == UNKNOWN).alias("unknown_state"),
        F.count_if(F.col("date_sent_key") == UNKNOWN).alias("unknown_date_sent"),
        F.count_if(F.col("is_timely").isNull()).alias("unknown_timely"),
    )


def table_sizes(star: dict[str, DataFrame]) -> DataFrame:
    return union_all([df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")) for name, df in star.items()])
