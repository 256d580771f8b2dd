"""Seeds, inline relations, the calendar, and tables kept as files."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from datetime import date
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

SEED_FOLDER = Path(__file__).parent / "seed_data"
# Seed file -> its columns, all text.
LOOKUP_ROW_GROUP = 32 * 1024 * 1024  # smaller row groups than usual: a lookup reads one or two
SEEDS = {
    "product_map": ["product", "product_group"],
    "issue_map": ["issue_raw", "issue_clean"],
    "company_map": ["company_norm", "company_canonical"],
    "state_ref": ["state_code", "state_name", "region"],
    "state_alias": ["state_raw", "state_code"],
}


def inline_relation(spark: SparkSession, rows: Sequence[Sequence], schema: str | StructType) -> DataFrame:
    """Literal rows as a local relation, so Catalyst knows the exact size."""
    struct = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    struct = StructType([StructField(f.name, f.dataType, True) for f in struct.fields])
    columns = list(zip(*rows)) if rows else [[] for _ in struct.fields]
    arrow = to_arrow_schema(struct)
    arrays = [pa.array(list(values), type=f.type) for values, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema=struct)


def unnest_values(spark: SparkSession, values: Sequence, name: str) -> DataFrame:
    """An array literal turned into rows."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in values])).alias(name))


def seed_rows(name: str) -> list[list[str]]:
    with (SEED_FOLDER / f"{name}.csv").open(encoding="utf-8", newline="") as f:
        lines = (line for line in f if not line.startswith("#"))
        header, *rows = csv.reader(lines)
    if header != SEEDS[name]:
        raise ValueError(f"seed {name} has columns {header}")
    return rows


def load_seed(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    """A reviewed lookup table, every column text (A8): the packaged one, or ``folder/name.csv``."""
    schema = ", ".join(f"{c} STRING" for c in SEEDS[name])
    if folder is None:
        return inline_relation(spark, seed_rows(name), schema)
    return spark.read.options(header=True, comment="#", escape='"').schema(schema).csv(f"{folder}/{name}.csv")


def load_seeds(spark: SparkSession, folder: str | None = None) -> dict[str, DataFrame]:
    return {name: load_seed(spark, name, folder) for name in SEEDS}


def calendar(spark: SparkSession, first: date, end: date) -> DataFrame:
    """Every day from ``first`` up to, but not including, ``end`` (A10)."""
    days = F.sequence(F.lit(first), F.date_sub(F.lit(end), 1), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("d"))


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Create or replace a table kept as Parquet, and read it back.

    The result carries the file statistics, which is what the size check of ``lookup_join`` and
    Catalyst's own broadcast decision rely on.
    """
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_for_lookups(df: DataFrame, path: str, day: str, then: Sequence[str], row_id: str) -> DataFrame:
    """Replace a table laid out for lookups by day and by id: files hold ranges of days, sorted within, so that
    a filter on the day skips the other files and row groups by their statistics; a Bloom filter does the
    same for the id."""
    order = [F.col(day).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in then]]
    laid_out = df.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = laid_out.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{row_id}", "true")
    writer.option("parquet.block.size", str(LOOKUP_ROW_GROUP)).parquet(path)
    return df.sparkSession.read.parquet(path)
