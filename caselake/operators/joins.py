"""Lookup joins with a size check, temporal joins, orphan and fan-out measurements."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.session import materialise

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32
HOT_SHARE = 0.001
LONG_HISTORY = 64  # versions of one key


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Count rows and bytes of a lookup, stopping after ``max_rows`` + 1 rows.

    Meant for literal relations and written tables, where counting is cheap; a lookup that is
    itself a long query should be materialised first.
    """
    width = reduce(
        add,
        [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(1)) for c in df.columns],
    )
    widths = df.select(width.alias("w")).limit(max_rows + 1)
    if df.isLocal():  # literal rows: answered without a job
        sizes = [row["w"] for row in widths.collect()]
        rows, size = len(sizes), sum(sizes)
    else:
        rows, size = widths.agg(F.count("*"), F.coalesce(F.sum("w"), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def hot_keys(facts: DataFrame, on: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys (NULL included) with more than ``share`` of all rows: fewer than 1 / ``share`` of them."""
    counted = materialise(facts.groupBy(*on).agg(F.count("*").alias("_n")), "key_counts")
    total = counted.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    return counted.filter(F.col("_n") > share * total).select(*on)


def with_salt(facts: DataFrame, hot: DataFrame, on: Sequence[str], salts: int) -> DataFrame:
    """Rows of hot keys are dealt over ``salts`` by position, so that equal rows spread too; others get 0."""
    marked = hot.select(*[F.col(c).alias(f"_h_{c}") for c in on], F.lit(True).alias("_hot"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_h_{c}")) for c in on])
    dealt = F.when(F.col("_hot"), F.monotonically_increasing_id() % salts).otherwise(0).cast("int")
    return facts.join(F.broadcast(marked), same, "left").withColumn("_salt", dealt).drop("_hot", *[f"_h_{c}" for c in on])


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    condition: Column | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Join rows to a reference table on equal columns, plus an optional extra ``condition``.

    ``how`` is left or inner. The lookup is broadcast only if counting proves it small. Otherwise both
    sides are shuffled on (key, salt). Keys that a count shows to be hot (NULL too) are salted: their
    facts are dealt over the salts and only their lookup rows are repeated; all others join as they are.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"lookup_join is a left or inner join, not {how}")
    on = list(on)
    if fits_broadcast(lookup, max_rows, max_bytes):
        left, right, keys = facts, F.broadcast(lookup), on
    else:
        hot = hot_keys(facts, on)
        left, keys = with_salt(facts, hot, on, salts), [*on, "_salt"]
        marked = lookup.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), on, "left")
        every = F.array(*[F.lit(i) for i in range(salts)])
        right = marked.withColumn("_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0))))).drop("_hot")
    if condition is None:
        return left.join(right, keys, how).drop("_salt")
    right = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    equal = reduce(and_, [F.col(c) == F.col(f"_r_{c}") for c in keys])
    return left.join(right, equal & condition, how).drop("_salt", *[f"_r_{c}" for c in keys])


def apply_map(df: DataFrame, mapping: DataFrame, column: str, key: str, value: str, into: str) -> DataFrame:
    """Replace values by a reviewed map; values without an entry stay as they are."""
    small = mapping.select(F.col(key).alias(column), F.col(value).alias("_mapped"))
    return lookup_join(df, small, [column]).withColumn(into, F.coalesce("_mapped", column)).drop("_mapped")


def resolve_state(df: DataFrame, state_ref: DataFrame, state_alias: DataFrame, column: str = "state_raw") -> DataFrame:
    """Alias -> valid code -> region in two hops (C3, J9). Adds ``state`` and ``region``."""
    alias = state_alias.select(F.col("state_raw").alias(column), F.col("state_code").alias("_alias"))
    ref = state_ref.select(F.col("state_code").alias("_code"), F.col("state_code").alias("state"), "region")
    return (
        lookup_join(lookup_join(df, alias, [column]).withColumn("_code", F.coalesce("_alias", column)), ref, ["_code"])
        .withColumn(
            "region",
            F.coalesce("region", F.when(F.col(column).isNull(), "Unknown").otherwise("Invalid code")),
        )
        .drop("_alias", "_code")
    )


def temporal_join(
    facts: DataFrame,
    versions: DataFrame,
    on: Sequence[str],
    at: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    how: str = "inner",
    long_history: int = LONG_HISTORY,
) -> DataFrame:
    """Each row meets the version that was valid on its day: [valid_from, valid_to).

    Keys with a long history are joined on (key, block of days) instead of the key: every version is
    written once per block it touches. A key's block is as long as its versions are on average, so a
    history at most doubles, and a row meets the few versions of its block, not all of its key.
    """
    open_end = F.coalesce(F.col(valid_to), F.lit("9999-12-31").cast("date"))
    valid = (F.col(at) >= F.col(valid_from)) & (F.col(at) < open_end)
    long = versions.groupBy(*on).agg(F.count("*").alias("_versions")).filter(F.col("_versions") > long_history)
    if not long.limit(1).count():
        return lookup_join(facts, versions, on, how, condition=valid)
    rows, blocks = in_day_blocks(facts, versions, on, at, valid_from, valid_to, long_history)
    joined = lookup_join(rows, blocks, [*on, "_block"], how, condition=valid)
    return joined.select(*facts.columns, *[c for c in versions.columns if c not in on])


def in_day_blocks(
    facts: DataFrame, versions: DataFrame, on: Sequence[str], at: str, valid_from: str, valid_to: str, long_history: int = LONG_HISTORY
) -> tuple[DataFrame, DataFrame]:
    """Both sides of a temporal join with the column ``_block``; versions are cut to the days of ``facts``.

    Keys with at most ``long_history`` versions have one block, -1.
    """
    first, last = facts.agg(F.min(at), F.max(at)).first()
    if first is None:  # no day to be valid on
        return facts.withColumn("_block", F.lit(-1)), versions.limit(0).withColumn("_block", F.lit(-1))
    start = F.greatest(F.col(valid_from), F.lit(first))
    stop = F.least(F.coalesce(F.col(valid_to), F.lit("9999-12-31").cast("date")), F.date_add(F.lit(last), 1))
    clipped = versions.withColumns({"_start": F.datediff(start, F.lit(first)), "_days": F.datediff(stop, start)}).filter(F.col(valid_from).isNotNull() & (F.col("_days") > 0))
    many = clipped.groupBy(*on).agg(F.count("*").alias("_versions"), F.sum("_days").alias("_sum")).filter(F.col("_versions") > long_history)
    lengths = materialise(many.select(*on, F.ceil(F.col("_sum") / F.col("_versions")).cast("int").alias("_length")), "block_lengths")
    sized = lookup_join(clipped, lengths, on)
    touched = F.sequence(F.floor(F.col("_start") / F.col("_length")).cast("int"), F.floor((F.col("_start") + F.col("_days") - 1) / F.col("_length")).cast("int"))
    block = F.explode(F.coalesce(touched, F.array(F.lit(-1))))
    blocks = materialise(sized.withColumn("_block", block).select(*versions.columns, "_block"), "version_blocks")
    day = F.floor(F.datediff(F.col(at), F.lit(first)) / F.col("_length")).cast("int")
    rows = lookup_join(facts, lengths, on).withColumn("_block", F.when(F.col("_length").isNull(), -1).otherwise(day))
    return rows.select(*facts.columns, "_block"), blocks


def zero_preserving_count(
    members: DataFrame, rows: DataFrame, key: str, counted: str, predicate: Column, name: str
) -> DataFrame:
    """Left join that keeps members without rows: the filter stays on the right side.

    Rows are filtered and counted per key first, so a hot key reaches the join as one row.
    """
    counts = rows.filter(predicate).groupBy(key).agg(F.count(counted).alias("_n"))
    return members.join(counts, key, "left").select(key, F.coalesce("_n", F.lit(0)).cast("bigint").alias(name))


def matched_only_count(
    members: DataFrame, rows: DataFrame, key: str, counted: str, predicate: Column, name: str
) -> DataFrame:
    """The same join with the filter in WHERE: members without rows silently disappear."""
    counts = rows.filter(predicate).groupBy(key).agg(F.count(counted).alias(name))
    return members.join(counts, key)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key finds no parent (C9). A NULL key is an orphan too."""
    keys = parent.select(F.col(parent_key).alias("_parent_key")).distinct()
    return child.join(keys, child[child_key] == F.col("_parent_key"), "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, label: str) -> DataFrame:
    """(fk, orphans). The keys are counted first, so only distinct keys are joined."""
    per_key = child.groupBy(child_key).agg(F.count("*").alias("_n"))
    return orphans(per_key, parent, child_key, parent_key).agg(
        F.lit(label).alias("fk"), F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphans")
    )


def fan_out(facts: DataFrame, lookup: DataFrame, on: str, measure: str) -> DataFrame:
    """Real total next to the total after joining a key that is not unique.

    Multiplying each key's sum by its number of matches gives the joined total without building
    the multiplied rows.
    """
    per_key = facts.groupBy(on).agg(F.sum(measure).alias("_sum"))
    matches = lookup.groupBy(on).agg(F.count("*").alias("_matches"))
    return per_key.join(matches, on, "left").agg(
        F.sum("_sum").cast("bigint").alias("real_total"),
        F.sum(F.col("_sum") * F.col("_matches")).cast("bigint").alias("inflated_total"),
    )


def assert_no_fanout(lookup: DataFrame, on: Sequence[str]) -> DataFrame:
    """The lookup itself if its key is unique; raises otherwise."""
    double = lookup.groupBy(*on).count().filter("count > 1").first()
    if double is not None:
        raise ValueError(f"joining on {list(on)} would multiply rows, e.g. {double.asDict()}")
    return lookup


def not_in(df: DataFrame, column: str, values: DataFrame, value_column: str) -> DataFrame:
    """SQL NOT IN: one NULL among the values, and nothing qualifies (C11).

    Distinct non-NULL values feed an ordinary anti join; whether a NULL exists is one scalar.
    """
    has_null = values.select(F.coalesce(F.bool_or(F.col(value_column).isNull()), F.lit(False))).scalar()
    is_empty = values.select(F.count("*") == 0).scalar()
    kept = not_exists(df, column, values, value_column)
    return kept.filter(~has_null & (F.col(column).isNotNull() | is_empty))


def not_exists(df: DataFrame, column: str, values: DataFrame, value_column: str) -> DataFrame:
    """NULL-safe exclusion."""
    keys = values.select(F.col(value_column).alias("_value")).filter("_value IS NOT NULL").distinct()
    return df.join(keys, F.col(column) == F.col("_value"), "left_anti")


def in_either(df: DataFrame, column_a: str, keys_a: DataFrame, column_b: str, keys_b: DataFrame) -> DataFrame:
    """Rows whose column_a is in keys_a OR column_b is in keys_b."""
    a = keys_a.toDF("_a").distinct().withColumn("_in_a", F.lit(True))
    b = keys_b.toDF("_b").distinct().withColumn("_in_b", F.lit(True))
    flagged = lookup_join(
        lookup_join(df, a.withColumnRenamed("_a", column_a), [column_a]), b.withColumnRenamed("_b", column_b), [column_b]
    )
    return flagged.filter("_in_a OR _in_b").drop("_in_a", "_in_b")
