"""Data-quality checks: each returns the offending rows, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.operators.joins import orphans

WARN, ERROR = "warn", "error"
# Days since the last ingest before a warning and before an error.
FRESHNESS_DAYS = {WARN: 7, ERROR: 30}


class Check(NamedTuple):
    name: str
    bad_rows: DataFrame
    severity: str = ERROR


class RowCheck(NamedTuple):
    """A check that looks at one row at a time: all such checks of a table share one scan."""

    name: str
    rows: DataFrame
    is_bad: Column
    severity: str = ERROR


class KeyCheck(NamedTuple):
    """``columns`` are unique (L1: one column, NULL ignored; L5: several, NULL is a value) or, with a
    ``parent``, lead to one of its rows (L2, NULL ignored). All such checks share one exchange."""

    name: str
    rows: DataFrame
    columns: Sequence[str]
    severity: str = ERROR
    parent: DataFrame | None = None
    parent_column: str | None = None


class Result(NamedTuple):
    name: str
    severity: str
    bad_rows: int

    @property
    def passed(self) -> bool:
        return self.bad_rows == 0


class GateError(RuntimeError):
    """A check of severity error found rows; nothing downstream may be written."""


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once (L1)."""
    return unique_combination(df.filter(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once, with their count."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def relationships(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child values without a parent, with their number of rows (L2). A NULL child is no violation.

    Counted per value before the join, so a value that fills the child table is joined once.
    """
    values = child.filter(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count("*").alias("n"))
    return orphans(values, parent, child_key, parent_key)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their number of rows (L3)."""
    return df.filter(is_unlisted(column, values)).groupBy(column).agg(F.count("*").alias("n"))


def accepted_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Values below ``low`` or above ``high``; both are allowed values, NULL is ignored (L4)."""
    return df.filter(is_outside(column, low, high)).select(F.col(column).alias("failing_value"))


def is_outside(column: str, low=None, high=None) -> Column:
    """True for a known value below ``low`` or above ``high``."""
    value, outside = F.col(column), F.lit(False)
    if low is not None:
        outside = outside | (value < F.lit(low))
    if high is not None:
        outside = outside | (value > F.lit(high))
    return value.isNotNull() & outside


def is_unlisted(column: str, values: Sequence) -> Column:
    """True for a known value outside the list."""
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def bronze_reconciles(bronze: DataFrame, staged: DataFrame, silver: DataFrame) -> DataFrame:
    """The four counts, if clean rows differ from the distinct usable ids or rows are missing."""
    usable = F.col("complaint_id").isNotNull() & F.col("date_received").isNotNull()
    ids = F.count_distinct(F.when(usable, F.col("complaint_id")))
    counts = staged.agg(F.count_if(~usable).alias("rejected_rows"), ids.alias("distinct_valid_ids")).select(
        bronze.select(F.count("*")).scalar().alias("bronze_rows"),
        "rejected_rows",
        silver.select(F.count("*")).scalar().alias("clean_rows"),
        "distinct_valid_ids",
    )
    return counts.filter("clean_rows <> distinct_valid_ids OR bronze_rows < clean_rows + rejected_rows")


def totals_add_back(clean: DataFrame, models: dict[str, tuple[DataFrame, str | None, Column]]) -> DataFrame:
    """Models whose total differs from the clean table.

    ``models``: name -> (table, column to sum or None to count rows, condition on clean rows).
    """
    parts = []
    for name, (table, column, condition) in models.items():
        total = F.count("*") if column is None else F.coalesce(F.sum(column), F.lit(0))
        expected = clean.select(F.count_if(condition)).scalar()
        parts.append(
            table.agg(F.lit(name).alias("model"), total.cast("bigint").alias("model_total"), expected.alias("expected"))
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.filter("model_total <> expected")


def merged_across_legal_forms(lookup: DataFrame) -> DataFrame:
    """Companies the rules merged although their spellings show different legal forms."""
    automatic = lookup.filter(~F.col("mapped_by_seed")).select("company", "company_raw", "legal_form")
    form = F.nullif("legal_form", F.lit(""))
    # two forms differ exactly if the smallest and the largest do; only such companies are gathered
    several = automatic.groupBy("company").agg(F.min(form).alias("_lo"), F.max(form).alias("_hi")).filter("_lo <> _hi")
    return (
        automatic.join(several.select("company"), "company", "left_semi")
        .groupBy("company")
        .agg(
            F.array_join(F.array_sort(F.collect_set("legal_form")), " | ").alias("legal_forms"),
            F.array_join(F.array_sort(F.collect_list("company_raw")), " | ").alias("raw_spellings"),
        )
    )


def partial_month_not_latest(monthly: DataFrame) -> DataFrame:
    """Months marked as running although a later one exists."""
    latest = monthly.select(F.max("month")).scalar()
    return monthly.filter(F.col("is_partial_month") & (F.col("month") != latest)).select("month").distinct()


def freshness(bronze: DataFrame, now: datetime, limits: dict[str, int] = FRESHNESS_DAYS) -> DataFrame:
    """Age of the last ingest in days and its state: pass, warn or error."""
    age = (F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds(F.max("_ingested_at"))) / F.lit(86400.0)
    state = (
        F.when(F.col("age_days").isNull() | (F.col("age_days") > limits[ERROR]), ERROR)
        .when(F.col("age_days") > limits[WARN], WARN)
        .otherwise("pass")
    )
    return bronze.agg(F.max("_ingested_at").alias("last_ingest"), age.alias("age_days")).withColumn("state", state)


def freshness_violations(bronze: DataFrame, now: datetime, severity: str = ERROR) -> DataFrame:
    states = [ERROR] if severity == ERROR else [WARN, ERROR]
    return freshness(bronze, now).filter(F.col("state").isin(*states))


def recent_rows(silver: DataFrame, days: int = 7) -> DataFrame:
    """First and last day, and the rows of the last ``days`` days."""
    per_day = silver.groupBy("date_received").agg(F.count("*").alias("n"))
    last = per_day.select(F.max("date_received")).scalar()
    recent = F.sum(F.when(F.col("date_received") >= F.date_sub(last, days), F.col("n")).otherwise(0))
    return per_day.agg(
        F.min("date_received").alias("first_date"),
        F.max("date_received").alias("last_date"),
        F.coalesce(recent, F.lit(0)).cast("bigint").alias(f"rows_last_{days}_days"),
    )


def key_violations(checks: Sequence[KeyCheck]) -> DataFrame:
    """(i, n): number of values that fail the i-th check; a check without such values has no row.

    Every table is read once. A row gives one (check, 128-bit digest of the key) per check; these are
    counted on the map side and meet in one exchange, whatever the number of checks and tables. Values
    are compared as texts, so a key and its reference may differ in type.
    """
    sides: dict[int, tuple[DataFrame, list[Column]]] = {}

    def add(df: DataFrame, i: int, columns: Sequence[str], child: bool, skip_null: bool) -> None:
        parts = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("")) for c in columns]
        key = F.struct(
            F.lit(i).alias("i"), F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit("second"), *parts).alias("h2"),
            F.lit(int(child)).cast("bigint").alias("child"), F.lit(int(not child)).cast("bigint").alias("parent"),
        )
        known = F.col(f"`{columns[0]}`").isNotNull() if skip_null else F.lit(True)
        sides.setdefault(id(df), (df, []))[1].append(F.when(known, key))

    for i, check in enumerate(checks):
        add(check.rows, i, check.columns, True, len(check.columns) == 1)
        if check.parent is not None:
            add(check.parent, i, [check.parent_column or check.columns[0]], False, True)
    keys = [df.select(F.explode(F.array_compact(F.array(*found))).alias("k")).select("k.*") for df, found in sides.values()]
    met = reduce(DataFrame.unionByName, keys).groupBy("i", "h1", "h2").agg(F.sum("child").alias("child"), F.sum("parent").alias("parent"))
    refers = F.array(*[F.lit(c.parent is not None) for c in checks])
    bad = F.when(F.get(refers, F.col("i")), (F.col("child") > 0) & (F.col("parent") == 0)).otherwise(F.col("child") > 1)
    return met.filter(bad).groupBy("i").agg(F.count("*").alias("n"))


def exact_key_violations(check: KeyCheck) -> DataFrame:
    """The failing values of one check."""
    if check.parent is not None:
        return relationships(check.rows, check.parent, check.columns[0], check.parent_column or check.columns[0])
    return unique(check.rows, check.columns[0]) if len(check.columns) == 1 else unique_combination(check.rows, check.columns)


def run_checks(checks: Sequence[Check | RowCheck | KeyCheck]) -> list[Result]:
    """Count the bad rows of every check: one number per check reaches the driver.

    What the digests of a key check report is counted again on the values themselves.
    """
    counts: list[DataFrame] = []
    by_table: dict[int, list[int]] = {}
    keyed = [i for i, check in enumerate(checks) if isinstance(check, KeyCheck)]
    for i, check in enumerate(checks):
        if isinstance(check, RowCheck):
            by_table.setdefault(id(check.rows), []).append(i)
        elif isinstance(check, Check):
            counts.append(check.bad_rows.agg(F.lit(i).alias("i"), F.count("*").alias("n")))
    for members in by_table.values():
        wide = checks[members[0]].rows.agg(*[F.count_if(checks[i].is_bad).alias(f"c{i}") for i in members])
        pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"c{i}").alias("n")) for i in members])
        counts.append(wide.select(F.inline(pairs)))
    if keyed:
        place = F.array(*map(F.lit, keyed))
        counts.append(key_violations([checks[i] for i in keyed]).select(F.get(place, F.col("i")).alias("i"), "n"))
    found = {row["i"]: row["n"] for row in reduce(DataFrame.unionByName, counts).collect()} if counts else {}
    for i in keyed:
        if found.get(i):
            found[i] = exact_key_violations(checks[i]).count()
    return [Result(c.name, c.severity, found.get(i, 0)) for i, c in enumerate(checks)]


def gate(checks: Sequence[Check | RowCheck | KeyCheck]) -> list[Result]:
    """Run the checks and stop if an error-level one fails; warnings are only reported."""
    results = run_checks(checks)
    failed = [f"{r.name}: {r.bad_rows} bad rows" for r in results if r.severity == ERROR and not r.passed]
    if failed:
        raise GateError("; ".join(failed))
    return results
