"""Latest row per key, global numbering, ranks and running counts without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.operators.joins import lookup_join
from caselake.operators.scans import PIECES, RANGE_ROWS, positions, running_sums
from caselake.session import materialise

SINGLE_TASK_ROWS = 1_000_000
SAMPLE_ROWS = 20_000


def total_order(df: DataFrame, leading: Sequence[Column], first_columns: Sequence[str] = ()) -> list[Column]:
    """``leading`` order plus every column as tie-breaker, so that the result never depends on
    how the rows are spread over tasks."""
    rest = [*first_columns, *[c for c in df.columns if c not in first_columns]]
    return [*leading, *[F.col(f"`{c}`").asc_nulls_last() for c in rest]]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order`` (E8, K-S3).

    Filtering a row number on 1 lets Spark cut every group to one row per map task before the
    shuffle (WindowGroupLimit), so copies of one hot key never meet in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dense_keys(
    members: DataFrame,
    order: Sequence[str],
    name: str,
    max_single_task: int = SINGLE_TASK_ROWS,
    buckets: int = 200,
) -> DataFrame:
    """ROW_NUMBER() over the sorted members of a dimension (E10), NULLs last.

    Small member lists are numbered by one window. Larger ones are cut into ranges at sampled
    split points; every range is numbered on its own and shifted by the sizes of the ranges
    before it. Both ways give the same numbers.
    """
    ordering = [F.col(c).asc_nulls_last() for c in order]
    total = members.limit(max_single_task + 1).count()
    if total <= max_single_task:
        return members.select(F.row_number().over(Window.orderBy(*ordering)).cast("int").alias(name), "*")
    total = members.count()
    sample = (
        members.select(*order)
        .sample(fraction=min(1.0, SAMPLE_ROWS / total), seed=7)
        .orderBy(*ordering)
        .limit(2 * SAMPLE_ROWS)
        .collect()
    )
    step = max(1, len(sample) // buckets)
    return _numbered_in_ranges(members, order, sample[step::step], name)


def _comparable(columns: Sequence[Column]) -> Column:
    # (is NULL, value) pairs compare like NULLS LAST
    parts = []
    for i, c in enumerate(columns):
        parts += [c.isNull().alias(f"n{i}"), c.alias(f"v{i}")]
    return F.struct(*parts)


def _numbered_in_ranges(members: DataFrame, order: Sequence[str], bounds: Sequence, name: str) -> DataFrame:
    types = {f.name: f.dataType for f in members.schema.fields}
    here = _comparable([F.col(c) for c in order])
    literals = [_comparable([F.lit(row[c]).cast(types[c]) for c in order]) for row in bounds]
    bucket = F.size(F.filter(F.array(*literals), lambda b: b <= here)) if literals else F.lit(0)
    placed = members.withColumn("_bucket", bucket)
    sizes = placed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_bucket").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return (
        placed.withColumn("_rn", F.row_number().over(within))
        .join(F.broadcast(offsets), "_bucket")  # at most len(bounds) + 1 rows
        .select((F.col("_rn") + F.col("_offset")).cast("int").alias(name), *members.columns)
    )


def global_rank(df: DataFrame, column: str, name: str = "rnk", descending: bool = True, range_rows: int = RANGE_ROWS) -> DataFrame:
    """RANK() over the whole table (E11): 1 + number of rows with a better value.

    Rows are counted per distinct value first; the counts are summed up in order, range by range.
    """
    counted = materialise(df.groupBy(F.col(column).alias("_value")).agg(F.count("*").alias("_n")), "rank_values")
    summed = running_sums(counted, ["_value"], ["_n"], ["_value"] if descending else [], range_rows)
    ranks = summed.select(F.struct(F.col("_value").alias("v")).alias("_key"), (F.col("before__n") + 1).cast("bigint").alias(name))
    flagged = df.withColumn("_key", F.struct(F.col(column).alias("v")))  # a struct key matches NULL too
    return lookup_join(flagged, materialise(ranks, "ranks"), ["_key"], "inner").drop("_key")


def running_counts(df: DataFrame, day: str, row_id: str, range_rows: int = RANGE_ROWS, pieces: int = PIECES) -> DataFrame:
    """Running count with the default RANGE frame (ties counted together) and with a ROWS frame
    (1, 2, 3 ... in id order), over the whole table (E3), NULL days last.

    Equal to two window functions over everything, but numbered in pieces of one day and one id
    range; the sums before a day come from a scan over ranges of days (scans.py).
    """
    placed = positions(df, day, row_id, range_rows=range_rows, pieces=pieces)
    return placed.select(*df.columns, F.col("upto").alias("default_range_frame"), F.col("row_num").alias("rows_frame"))
