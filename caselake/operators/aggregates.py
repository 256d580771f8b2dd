"""Grouped measures, exact percentiles, profiles and series operators."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.functions.columns import month_of, pct, round_half
from caselake.operators.numbering import SINGLE_TASK_ROWS
from caselake.operators.scans import MOST_RANGES, ordering, positions, range_of, selected_percentiles, split_points
from caselake.session import materialise


def count_by(df: DataFrame, *keys: Column | str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def count_by_month(df: DataFrame, key: str, day: str, name: str = "n") -> DataFrame:
    """(key, month, n): the base of every monthly series."""
    return df.groupBy(key, month_of(day).alias("month")).agg(F.count("*").alias(name))


def count_kinds(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """count(*), count(column) and count(DISTINCT column) side by side (D3).

    Counted per value first, so every value reaches the second aggregation once per task.
    """
    per_value = df.groupBy(*keys, column).agg(F.count("*").alias("_n"))
    return per_value.groupBy(*keys).agg(
        F.sum("_n").cast("bigint").alias("all_rows"),
        F.coalesce(F.sum(F.when(F.col(column).isNotNull(), F.col("_n"))), F.lit(0)).cast("bigint").alias("known_rows"),
        F.count(column).alias("distinct_values"),
    )


def distinct_combinations(columns: Sequence[str]) -> Column:
    """Distinct count of a combination; a combination with a NULL part counts as well."""
    return F.count_distinct(F.struct(*columns))


def filtered_count(condition: Column) -> Column:
    """count(*) FILTER (WHERE condition)."""
    return F.count_if(condition)


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, percentages: dict[str, float], *extra: tuple[str, Column], few_values: bool = False
) -> DataFrame:
    """Exact interpolated percentiles per key (D10), with any extra (name, aggregate) columns.

    Equal values are counted before the second aggregation, so a key that holds nearly all rows
    arrives as one list of distinct values, never as rows. If these are few by their nature (days of the
    calendar), ``few_values`` takes the built-in aggregate, whose buffer holds the list. Otherwise the
    ranks are selected by ranges (scans.py) and no list is held. Extra aggregates see the columns ``value``
    and ``_n`` (how often it occurred).
    """
    if not few_values:
        return selected_percentiles(df, keys, value, percentages, *extra)
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return counted.groupBy(*keys).agg(
        F.sum("_n").cast("bigint").alias("n"),
        *[agg.alias(name) for name, agg in extra],
        *[F.percentile(value, p, F.col("_n")).alias(name) for name, p in percentages.items()],
    )


def weighted_mean(value: str, digits: int = 2) -> Column:
    """Mean of ``value`` over counted rows, NULLs left out, rounded once."""
    value_known = F.when(F.col(value).isNotNull(), F.col("_n"))
    return round_half(
        F.sum(F.col(value) * F.col("_n")).cast("double") / F.nullif(F.sum(value_known).cast("double"), F.lit(0.0)),
        digits,
    )


def period_over_period(series: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Previous row, change and change in percent per key (E1). Gaps are not filled.

    ``series`` is an aggregate: one row per key and period.
    """
    previous = F.lag(value).over(Window.partitionBy(key).orderBy(F.asc_nulls_last(order)))
    with_previous = series.withColumn("prev_n", previous)
    change = F.col(value) - F.col("prev_n")
    return with_previous.select(
        key, order, value, "prev_n", change.alias("mom_change"), pct(change, F.col("prev_n"), 1).alias("mom_pct")
    )


def running_total(series: DataFrame, key: str, order: str, value: str, name: str = "running_total") -> DataFrame:
    """Running sum per key over an aggregated series."""
    w = Window.partitionBy(key).orderBy(F.asc_nulls_last(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return series.withColumn(name, F.sum(value).over(w).cast("bigint"))


def moving_average(
    series: DataFrame, order: str, value: str, rows: int, name: str, digits: int = 1, keys: Sequence[str] = ()
) -> DataFrame:
    """Mean of this row and the rows before it, ``rows`` in all.

    Without ``keys`` the series is one row per period, so a single window task holds at most the
    number of periods in the calendar.
    """
    w = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(order)).rowsBetween(-(rows - 1), Window.currentRow)
    return series.withColumn(name, round_half(F.avg(value).over(w), digits))


def share_of_total(series: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Each row's part of its group's total in percent, over an aggregated series (E5)."""
    total = F.sum(value).over(Window.partitionBy(*keys))
    return series.withColumn(name, pct(F.col(value), total))


def top_n_per_group(
    counted: DataFrame, keys: Sequence[str], value: str, n: int, name: str = "rnk"
) -> DataFrame:
    """Rows whose dense rank within the group is at most ``n``; ties share a rank."""
    w = Window.partitionBy(*keys).orderBy(F.desc(value))
    return counted.withColumn(name, F.dense_rank().over(w).cast("bigint")).filter(F.col(name) <= n)


def ranks(counted: DataFrame, value: str, tie_breaker: str, max_single_task: int = SINGLE_TASK_ROWS) -> DataFrame:
    """ROW_NUMBER, RANK and DENSE_RANK next to each other (E6), largest value first, NULLs last.

    A short list is numbered by one window; a longer one by a scan over ranges of values (scans.py).
    """
    if counted.limit(max_single_task + 1).count() > max_single_task:
        scanned = positions(materialise(counted, "ranked"), value, tie_breaker, descending=True)
        return scanned.select(*counted.columns, "row_num", "rnk", "dense_rnk")
    by_value = Window.orderBy(F.desc_nulls_last(value))
    return counted.select(
        "*",
        F.row_number().over(Window.orderBy(F.desc_nulls_last(value), F.asc_nulls_last(tie_breaker))).cast("bigint").alias("row_num"),
        F.rank().over(by_value).cast("bigint").alias("rnk"),
        F.dense_rank().over(by_value).cast("bigint").alias("dense_rnk"),
    )


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """ORDER BY ... LIMIT k; give an order without ties (F2)."""
    return df.orderBy(*order).limit(k)


def page(df: DataFrame, offset: int, rows: int, *order: Column) -> DataFrame:
    """OFFSET / FETCH."""
    return df.orderBy(*order).offset(offset).limit(rows)


class PagedTable(NamedTuple):
    """A table laid out for paging: files hold ranges of the order, and their row counts are known."""

    path: str
    columns: list[str]
    descending: list[str]
    counts: DataFrame  # part, rows


def write_for_paging(df: DataFrame, path: str, columns: Sequence[str], descending: Sequence[str] = (), part_rows: int = 1_000_000) -> PagedTable:
    """Write ``df`` in ranges of ``columns`` (NULLs last), one folder per range; give an order without ties."""
    stored = materialise(df, "paged_rows")
    total = stored.count()
    bounds = split_points(stored, columns, min(MOST_RANGES, -(-total // part_rows)), descending, total)
    placed = stored.withColumn("part", range_of(stored, columns, bounds, descending))
    placed.repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{path}/rows")
    counts = placed.groupBy("part").agg(F.count("*").alias("rows"))
    counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/counts")
    return PagedTable(path, list(columns), list(descending), df.sparkSession.read.schema(counts.schema).parquet(f"{path}/counts"))


def seek_page(table: PagedTable, offset: int, rows: int) -> DataFrame:
    """The page from ``offset`` on (F4), however far: the counts tell which ranges hold it, and only their
    files are read and ordered."""
    spark = table.counts.sparkSession
    before, first, parts, skip = 0, None, [], 0
    for part, n in sorted((r["part"], r["rows"]) for r in table.counts.collect()):  # at most ``MOST_RANGES``
        if before < offset + rows and before + n > offset:
            if first is None:
                first, skip = part, offset - before
            parts.append(part)
        before += n
    stored = spark.read.parquet(f"{table.path}/rows")
    return stored.filter(F.col("part").isin(parts)).drop("part").orderBy(*ordering(table.columns, table.descending)).offset(skip).limit(rows)


def reproducible_sample(df: DataFrame, row_id: str, size: int, seed: int = 42) -> DataFrame:
    """A fixed-size sample that depends only on ids and seed, not on the partitioning.

    The rows with the smallest lots (digests of seed and id) are taken. A bound on the lot, from the
    row count, leaves little more than ``size`` candidates; only their lots are ordered. Rows below
    the last lot are taken by a filter, and only rows of that one lot compare all columns.
    """
    lot = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(row_id).cast("string")))
    total = df.count()
    if total <= size:
        return df
    lots, margin = None, 6 * size**0.5 + 20
    while lots is None or lots.limit(size).count() < size:
        share = min(1.0, (size + margin) / total)
        bound = f"{min(int(share * 16**8), 16**8 - 1):08x}"
        lots = df.select(lot.alias("lot")).filter(F.substring("lot", 1, 8) <= bound)
        margin *= 4
    last = lots.orderBy("lot").limit(size).agg(F.max("lot")).first()[0]
    below = df.filter(lot < last)
    ties = df.filter(lot == last).orderBy(*[F.asc_nulls_last(c) for c in df.columns])
    return below.unionByName(ties.limit(size - below.count()))


def first_and_last_seen(df: DataFrame, keys: Sequence[str], day: str, name: str = "n") -> DataFrame:
    """When a name appeared first and last, and how often."""
    return df.groupBy(*keys).agg(
        F.min(day).alias("first_seen"), F.max(day).alias("last_seen"), F.count("*").alias(name)
    )


def joined_text(values: Column | str, separator: str = " | ") -> Column:
    """Distinct values in sorted order as one text (D11). For aggregated, bounded groups."""
    return F.array_join(F.array_sort(F.collect_set(values)), separator)


def ratio_of_sums_and_mean_of_ratios(
    df: DataFrame, key: str, part: Column, whole: Column
) -> DataFrame:
    """The right and the wrong way to average a rate (D8): add the parts first, or average the
    groups' percentages."""
    parts = df.groupBy(key).agg(F.sum(part).alias("_part"), F.sum(whole).alias("_whole")).filter("_whole > 0")
    return parts.agg(
        F.count("*").alias("groups"),
        pct(F.sum("_part"), F.sum("_whole")).alias("ratio_of_sums"),
        round_half(F.avg(F.lit(100.0) * F.col("_part") / F.col("_whole")), 2).alias("mean_of_ratios"),
    )


def _unpivot(row: DataFrame, entries: Sequence[tuple[str, dict[str, str]]], names: Sequence[str]) -> DataFrame:
    """One wide aggregate row -> one row per column."""
    rows = [
        F.struct(F.lit(label).alias("column_name"), *[F.col(source[n]).alias(n) for n in names])
        for label, source in entries
    ]
    return row.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def null_percentages(df: DataFrame, columns: dict[str, str] | Sequence[str]) -> DataFrame:
    """Share of NULLs per column in percent, three decimals (D17): one pass over the data."""
    labels = columns if isinstance(columns, dict) else {c: c for c in columns}
    wide = df.agg(
        *[pct(F.count_if(F.col(c).isNull()), F.count("*"), 3).alias(f"_{i}") for i, c in enumerate(labels.values())]
    )
    return _unpivot(wide, [(label, {"pct_null": f"_{i}"}) for i, label in enumerate(labels)], ["pct_null"])


def distinct_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Exact distinct count, range and NULL share per column.

    Values are unpivoted and counted per (column, value) first; a value that fills a third of a
    column is one row per task after that.
    """
    columns = list(columns or df.columns)
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns])
    )
    per_value = df.select(pairs.alias("p")).groupBy("p.column_name", "p.v").agg(F.count("*").alias("_n"))
    return per_value.groupBy("column_name").agg(
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        F.count("v").alias("unique_values"),
        F.sum("_n").cast("bigint").alias("count"),
        pct(F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("_n"))), F.lit(0)), F.sum("_n")).alias("null_percentage"),
    )
