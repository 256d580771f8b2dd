"""Running sums, ranks and exact percentiles over orders of any length, without a one-task window.

Every order is cut into ranges at sampled split points. Ranges are summed up on their own, their totals
are summed up by the same step over groups of ranges, level by level, and the sums before a range are
handed down. A window only ever sees one range, or one group of ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.session import materialise

RANGE_ROWS = 1_000_000
SAMPLE_ROWS = 20_000
MOST_RANGES = 4096
FAN = 64  # ranges per group, and split points compared at a time
VALUE_RANGES = 256  # of a percentile's values
PIECES = 64  # parts of one tie group


def ordering(columns: Sequence[str], descending: Sequence[str] = ()) -> list[Column]:
    """NULLs last, whichever way a column is ordered."""
    return [F.col(c).desc_nulls_last() if c in descending else F.col(c).asc_nulls_last() for c in columns]


def split_points(df: DataFrame, columns: Sequence[str], ranges: int, descending: Sequence[str] = (), total: int | None = None) -> list:
    """At most ``ranges`` - 1 rows (of ``columns``) of a sample of bounded size, in order and distinct."""
    total = df.count() if total is None else total
    if ranges < 2 or not total:
        return []
    sample = df.select(*columns).sample(fraction=min(1.0, SAMPLE_ROWS / total), seed=7).distinct()
    rows = sample.orderBy(*ordering(columns, descending)).limit(2 * SAMPLE_ROWS).collect()
    step = max(1, -(-len(rows) // ranges))
    return rows[step::step]


def _not_after(bound: Column, columns: Sequence[str], descending: Sequence[str]) -> Column:
    """bound <= the row's columns, in the order of ``ordering``."""
    last = F.lit(True)
    for c in reversed(columns):
        b, here = bound[c], F.col(c)
        less = (b > here) if c in descending else (b < here)
        before = (b.isNotNull() & here.isNull()) | F.coalesce(less, F.lit(False))
        last = before | (b.eqNullSafe(here) & last)
    return last


def range_of(df: DataFrame, columns: Sequence[str], bounds: Sequence, descending: Sequence[str] = ()) -> Column:
    """Number of the range a row falls in: how many bounds do not come after it. Groups of ``FAN`` bounds
    are compared first, then the bounds of one group."""
    if not bounds:
        return F.lit(0)
    types = {f.name: f.dataType for f in df.schema.fields}
    literal = lambda rows: F.array(*[F.struct(*[F.lit(r[c]).cast(types[c]).alias(c) for c in columns]) for r in rows])
    upto = lambda array: F.size(F.filter(array, lambda b: _not_after(b, columns, descending)))
    if len(bounds) <= FAN:
        return upto(literal(bounds))
    groups = [bounds[i : i + FAN] for i in range(0, len(bounds), FAN)]
    group = F.greatest(upto(literal([g[0] for g in groups])) - 1, F.lit(0))
    return group * FAN + upto(F.element_at(F.array(*map(literal, groups)), group + 1))


def sums_before(totals: DataFrame, index: str, values: Sequence[str]) -> DataFrame:
    """(index, before_<value> ...): sums over all rows with a smaller ``index`` (0, 1, 2, ... with gaps).

    A scan tree: groups of ``FAN`` indexes are summed up in one window each, and the groups' totals by
    the same function, as many levels as it takes.
    """
    grouped = totals.withColumn("_group", F.floor(F.col(index) / FAN))
    earlier = Window.partitionBy("_group").orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    inside = grouped.select(index, "_group", *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"before_{v}") for v in values])
    if not totals.filter(F.col(index) >= FAN).limit(1).count():
        return inside.drop("_group")
    upper = materialise(grouped.groupBy(F.col("_group").alias("_upper")).agg(*[F.sum(v).alias(v) for v in values]), "scan_level")
    upper = upper.withColumnRenamed("_upper", index)
    above = sums_before(upper, index, values).select(F.col(index).alias("_group"), *[F.col(f"before_{v}").alias(f"_above_{v}") for v in values])
    return inside.join(above, "_group").select(index, *[(F.col(f"before_{v}") + F.col(f"_above_{v}")).alias(f"before_{v}") for v in values])


def running_sums(
    df: DataFrame, columns: Sequence[str], values: Sequence[str], descending: Sequence[str] = (), range_rows: int = RANGE_ROWS
) -> DataFrame:
    """``df`` with before_<value> for every value: its sum over all rows earlier in the order of ``columns``.

    Rows must differ in ``columns`` (aggregate first). ``df`` is read several times: give a stored table.
    """
    total = df.count()
    bounds = split_points(df, columns, min(MOST_RANGES, -(-total // range_rows)), descending, total)
    placed = df.withColumn("_range", range_of(df, columns, bounds, descending))
    totals = placed.groupBy("_range").agg(*[F.sum(v).alias(v) for v in values])
    offsets = sums_before(materialise(totals, "scan_ranges"), "_range", values)
    offsets = offsets.select("_range", *[F.col(f"before_{v}").alias(f"_of_{v}") for v in values])
    earlier = Window.partitionBy("_range").orderBy(*ordering(columns, descending)).rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.select("*", *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_in_{v}") for v in values])
    # one row per range: never more than MOST_RANGES
    joined = inside.join(F.broadcast(offsets), "_range")
    return joined.select(*df.columns, *[(F.col(f"_in_{v}") + F.col(f"_of_{v}")).cast("bigint").alias(f"before_{v}") for v in values])


def positions(
    df: DataFrame, value: str, tie_breaker: str, descending: bool = False, range_rows: int = RANGE_ROWS, pieces: int = PIECES
) -> DataFrame:
    """row_num, rnk, dense_rnk and upto (rows up to and with the last equal one: the RANGE frame) of every
    row, ordered by ``value``, then ``tie_breaker`` ascending, NULLs last.

    Rows are numbered in pieces of one value and one range of the tie breaker, so a value that fills the
    table is spread over ``pieces`` tasks. Values are counted, and the counts summed up by ranges.
    """
    cuts = split_points(df, [tie_breaker], pieces)
    placed = df.withColumns(
        {"_value": F.struct(F.col(value).alias("v")), "_piece": range_of(df, [tie_breaker], cuts)}  # a struct key matches NULL too
    )
    sizes = materialise(placed.groupBy("_value", "_piece").agg(F.count("*").alias("_size")), "scan_pieces")
    of_value = sizes.groupBy("_value").agg(F.sum("_size").alias("rows"), F.lit(1).cast("bigint").alias("values"))
    of_value = materialise(of_value.select(F.col("_value.v").alias("v"), "rows", "values"), "scan_values")
    ranked = running_sums(of_value, ["v"], ["rows", "values"], ["v"] if descending else [], range_rows)
    ranked = ranked.select(F.struct("v").alias("_value"), "rows", "before_rows", "before_values")
    earlier = Window.partitionBy("_value").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)  # ``pieces`` rows
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0))).join(ranked, "_value")
    within = Window.partitionBy("_value", "_piece").orderBy(F.col(tie_breaker).asc_nulls_last())
    numbered = placed.withColumn("_rn", F.row_number().over(within))
    return numbered.join(offsets, ["_value", "_piece"]).select(
        *df.columns,
        (F.col("before_rows") + F.col("_before") + F.col("_rn")).cast("bigint").alias("row_num"),
        (F.col("before_rows") + 1).cast("bigint").alias("rnk"),
        (F.col("before_values") + 1).cast("bigint").alias("dense_rnk"),
        (F.col("before_rows") + F.col("rows")).cast("bigint").alias("upto"),
    )


def selected_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, percentages: dict[str, float], *extra: tuple[str, Column], buckets: int = VALUE_RANGES
) -> DataFrame:
    """keys, n (rows of the key), extra aggregates and exact interpolated percentiles (D10) of values with any
    number of distinct ones; NULL values are left out of the percentiles.

    Selection instead of sorting: the values of all keys are counted in ``buckets`` ranges; per key and
    percentage the ranges that hold its two neighbouring ranks are found from the counts, and only the
    distinct values of those ranges are ordered. No buffer holds the values of a key.
    """
    struct = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    narrow = df.select(struct.alias("_key"), F.col(value).cast("double").alias("_v"))
    counted = materialise(narrow.groupBy("_key", "_v").agg(F.count("*").alias("_n")), "percentile_values")
    known = counted.filter(F.col("_v").isNotNull())
    bounds = split_points(known, ["_v"], buckets)
    placed = known.withColumn("_range", range_of(known, ["_v"], bounds))
    histogram = materialise(placed.groupBy("_key", "_range").agg(F.sum("_n").alias("_n")), "percentile_ranges")
    # per key at most ``buckets`` rows
    earlier = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_key")
    stacked = histogram.select(
        "_key", "_range", "_n", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("_rows")
    )
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(p)).alias("p")) for name, p in percentages.items()]))
    asked = stacked.select("*", wanted.alias("_w")).withColumn("_at", F.col("_w.p") * (F.col("_rows") - 1))
    # ranks floor(at) and ceil(at), from 0
    holds = (F.col("_before") <= F.ceil("_at")) & (F.floor("_at") < F.col("_before") + F.col("_n"))
    ranges = materialise(asked.filter(holds).select("_key", "_range", "_before", F.col("_w.name").alias("_name"), "_at"), "percentile_asked")
    needed = placed.join(ranges.select("_key", "_range").distinct(), ["_key", "_range"], "left_semi")
    inside = Window.partitionBy("_key", "_range").orderBy("_v")
    ordered = needed.withColumn("_upto", F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    met = ordered.join(ranges, ["_key", "_range"]).withColumn("_first", F.col("_before") + F.col("_upto") - F.col("_n"))
    covers = lambda rank: (F.col("_first") <= rank) & (rank < F.col("_before") + F.col("_upto"))
    low, high = F.max(F.when(covers(F.floor("_at")), F.col("_v"))), F.max(F.when(covers(F.ceil("_at")), F.col("_v")))
    found = met.groupBy("_key", "_name").agg(low.alias("_low"), high.alias("_high"), F.max("_at").alias("_at"))
    part = F.col("_at") - F.floor("_at")
    # the same arithmetic as the built-in function
    exact = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise((F.ceil("_at") - F.col("_at")) * F.col("_low") + part * F.col("_high"))
    found = found.withColumn("_value", exact)
    wide = found.groupBy("_key").agg(*[F.max(F.when(F.col("_name") == name, F.col("_value"))).alias(name) for name in percentages])
    totals = counted.withColumn(value, F.col("_v")).groupBy("_key").agg(
        F.sum("_n").cast("bigint").alias("n"), *[agg.alias(name) for name, agg in extra]
    )
    joined = totals.join(wide, "_key", "left")
    return joined.select(*[F.col(f"_key.k{i}").alias(k) for i, k in enumerate(keys)], "n", *[name for name, _ in extra], *percentages)

