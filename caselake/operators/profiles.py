"""Column profiles from sketches that are stored per batch and merged when asked for.

A batch is read once. Per column it leaves counts, range, moments, a HyperLogLog sketch of the distinct
values and a KLL sketch of the quantiles: a few kilobytes, whatever the number of rows. All of these
merge, so the profile of a growing table only reads new batches, and a batch that comes again
replaces its own row. The state of a task is the same few kilobytes per batch and column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake.functions.columns import pct

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMERIC = (*WHOLE, T.FloatType, T.DoubleType, T.DecimalType)
TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
QUANTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
PROFILE_FIELDS = ["column_type", "min", "max", "approx_unique", "avg", "std", *QUANTILES, "count", "null_percentage"]
DISTINCT_BITS = 14  # 0.8 % error
QUANTILE_SIZE = 800  # 0.4 % of the rows


def _as_number(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, NUMERIC):
        return column.cast("double")
    if isinstance(kind, TIMES):  # seconds since 1970
        return F.unix_seconds(column.cast("timestamp")).cast("double")
    return F.lit(None).cast("double")


def batch_sketches(df: DataFrame, batch: Column | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """(batch, place, column_name, column_type, rows, known, low, high, low_whole, high_whole, low_number,
    high_number, mean, spread, distinct, quantiles): one row per batch and column, from one pass over ``df``."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    aggregates, rows = [F.count("*").alias("_rows")], []
    for i, field in enumerate(fields):
        c = F.col(f"`{field.name}`")
        number = _as_number(c, field.dataType)
        text, whole = isinstance(field.dataType, T.StringType), c if isinstance(field.dataType, WHOLE) else F.lit(None)
        values = {
            "known": F.count(c),
            "low": F.min(c).cast("string") if text else F.lit(None).cast("string"),
            "high": F.max(c).cast("string") if text else F.lit(None).cast("string"),
            "low_whole": F.min(whole.cast("bigint")),
            "high_whole": F.max(whole.cast("bigint")),
            "low_number": F.min(number),
            "high_number": F.max(number),
            "mean": F.avg(number),
            "spread": F.var_pop(number),
            "distinct": F.hll_sketch_agg(c.cast("string"), DISTINCT_BITS),
            "quantiles": F.kll_sketch_agg_double(number, QUANTILE_SIZE),
        }
        aggregates += [agg.alias(f"_{i}_{n}") for n, agg in values.items()]
        fixed = [F.lit(i).alias("place"), F.lit(field.name).alias("column_name"), F.lit(field.dataType.simpleString()).alias("column_type"), F.col("_rows").alias("rows")]
        rows.append(F.struct(*fixed, *[F.col(f"_{i}_{n}").alias(n) for n in values]))
    grouped = df.groupBy((F.lit("") if batch is None else batch.cast("string")).alias("batch")).agg(*aggregates)
    return grouped.select("batch", F.explode(F.array(*rows)).alias("r")).select("batch", "r.*")


def store_sketches(sketches: DataFrame, path: str) -> None:
    """Write them beside those of other batches; a batch that comes again replaces itself."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def stored_sketches(spark: SparkSession, path: str, batches: Sequence[str] | None = None) -> DataFrame:
    stored = spark.read.parquet(path).withColumn("batch", F.col("batch").cast("string"))
    return stored if batches is None else stored.filter(F.col("batch").isin(list(batches)))


def merged_profile(sketches: DataFrame) -> DataFrame:
    """column_name and ``PROFILE_FIELDS`` of all rows the sketches stand for. Range and quantiles are texts:
    numbers as they are, dates and times as such."""
    n = F.sum("known").cast("double")
    mean = F.sum(F.col("known") * F.col("mean")) / F.nullif(F.sum(F.when(F.col("mean").isNotNull(), F.col("known"))).cast("double"), F.lit(0.0))
    squares = F.sum(F.col("known") * (F.col("spread") + F.col("mean") * F.col("mean")))
    merged = sketches.groupBy("place", "column_name", "column_type").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("low_whole").cast("string").alias("low_whole"),
        F.max("high_whole").cast("string").alias("high_whole"), F.min("low_number").alias("low_number"), F.max("high_number").alias("high_number"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("approx_unique"),
        mean.alias("avg"), squares.alias("_squares"), n.alias("_n"),
        F.kll_merge_agg_double("quantiles").alias("_quantiles"), F.count_if(F.col("low_number").isNotNull()).alias("_sketched"),
        F.sum("rows").cast("bigint").alias("count"), pct(F.sum(F.col("rows") - F.col("known")), F.sum("rows")).alias("null_percentage"),
    )

    def as_text(number: Column) -> Column:
        moment = F.timestamp_seconds(number.cast("bigint"))
        day = F.when(F.col("column_type") == "date", F.date_format(moment, "yyyy-MM-dd")).otherwise(F.date_format(moment, "yyyy-MM-dd HH:mm:ss"))
        whole = F.col("column_type").isin("tinyint", "smallint", "int", "bigint")
        plain = F.when(whole, number.cast("bigint").cast("string")).otherwise(number.cast("string"))
        return F.when(F.col("column_type").isin("date", "timestamp", "timestamp_ntz"), day).otherwise(plain)

    timed = F.col("column_type").isin("date", "timestamp", "timestamp_ntz")
    variance = (F.col("_squares") - F.col("_n") * F.col("avg") * F.col("avg")) / (F.col("_n") - 1)
    quantile = lambda p: F.when(F.col("_sketched") > 0, F.kll_sketch_get_quantile_double("_quantiles", F.lit(p)))
    return merged.select(
        "place", "column_name", "column_type",
        F.coalesce("low", "low_whole", as_text(F.col("low_number"))).alias("min"), F.coalesce("high", "high_whole", as_text(F.col("high_number"))).alias("max"),
        "approx_unique", F.when(~timed, F.col("avg")).alias("avg"),
        F.when(~timed & (F.col("_n") > 1) & variance.isNotNull(), F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("std"),
        *[as_text(quantile(p)).alias(q) for q, p in QUANTILES.items()], "count", "null_percentage",
    ).orderBy("place").drop("place")


def profile(df: DataFrame) -> DataFrame:
    """Type, range, distinct values, spread, quantiles and NULL share of every column, in one pass."""
    return merged_profile(batch_sketches(df))
