"""Reload of single batches without a rebuild: changed ids reach Silver, changed counts reach summaries (A6, A13, K-S5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake.operators.joins import fits_broadcast, lookup_join
from caselake.plans.silver import SILVER_COLUMNS, build_company_lookup, enrich, keep_latest, quality_flags, stage, usable
from caselake.session import materialise, remove_folder

MONTH = "received_month"
LOOKUP = ["company_raw", "company"]


def by_month(silver: DataFrame) -> DataFrame:
    return silver.withColumn(MONTH, F.date_format("date_received", "yyyy-MM"))


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def overwrite_parts(content: DataFrame, path: str, key: str, touched: DataFrame) -> list[str]:
    """Replace the parts ``touched`` (a column ``key`` of texts) of a table kept in folders; all other files stay.

    ``content`` may read the same table: it is stored elsewhere before anything is replaced. A part that
    is left without rows is removed. Returns the parts.
    """
    spark = content.sparkSession
    content = materialise(content, "reloaded_parts")
    content.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)
    parts = sorted(r[key] for r in touched.distinct().collect())  # months or batches, not rows
    filled = {r[key] for r in content.select(key).distinct().collect()}
    for part in parts:
        if part not in filled:
            remove_folder(spark, f"{path}/{key}={part}")
    return parts


def write_silver(bronze: DataFrame, seeds: dict[str, DataFrame], path: str, lookup_path: str) -> DataFrame:
    """Silver in one folder per month of receipt, with the lookup it was built with."""
    lookup = build_company_lookup(bronze, seeds, lambda df: _written(df, lookup_path))
    silver = by_month(_silver_rows(usable(stage(bronze)), lookup, seeds))
    silver.write.mode("overwrite").partitionBy(MONTH).parquet(path)
    return _stored(bronze.sparkSession, path, silver.schema)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return _stored(df.sparkSession, path, df.schema)


def _silver_rows(rows: DataFrame, lookup: DataFrame, seeds: dict[str, DataFrame], ids: DataFrame | None = None) -> DataFrame:
    latest = latest_of(rows.drop("complaint_id_raw"), ids) if ids is not None else keep_latest(rows.drop("complaint_id_raw"))
    return quality_flags(enrich(latest, lookup, seeds)).select(*SILVER_COLUMNS)


def latest_of(rows: DataFrame, ids: DataFrame, **limits: int) -> DataFrame:
    """The latest row of each of ``ids`` (distinct, a written table).

    A few ids are broadcast, and only their rows are shuffled. Otherwise copies go before the shuffle, and
    the ids meet the rows that are left where these already lie. An inner join, as Catalyst would move a
    semi join below the window, and so shuffle every copy.
    """
    if fits_broadcast(ids, **limits):
        return keep_latest(rows.join(F.broadcast(ids), "complaint_id", "left_semi"))
    return keep_latest(rows).join(ids, "complaint_id").select(*rows.columns)


def reload_batches(bronze: DataFrame, batches: Sequence[str], seeds: dict[str, DataFrame], path: str, lookup_path: str) -> list[str]:
    """Bring a stored Silver up to date after ``batches`` of Bronze were replaced, added or dropped.

    ``bronze`` is the table as it is now. An id is affected if a changed batch holds it now, if its stored
    row came from one, or if the company of its spelling changed with the lookup. The rows of affected
    ids are built again from all batches, and only the months they leave or enter are written. Returns
    these months. Equal to building everything anew.
    """
    spark = bronze.sparkSession
    rows = usable(stage(bronze))
    schema = T.StructType([*_silver_rows(rows, spark.createDataFrame([], "company_raw STRING, company STRING"), seeds).schema.fields, T.StructField(MONTH, T.StringType())])
    silver = _stored(spark, path, schema)
    changed = F.col("_batch_id").isin(list(batches))
    before = spark.read.parquet(lookup_path).select("company_raw", F.col("company").alias("_before"))
    lookup = build_company_lookup(bronze, seeds)
    renamed = lookup_join(lookup.select(*LOOKUP), materialise(before, "lookup_before"), ["company_raw"])
    renamed = materialise(renamed.filter(~F.col("company").eqNullSafe(F.col("_before"))).select("company_raw"), "renamed_companies")
    held = rows.filter(changed).select("complaint_id")
    left = silver.filter(changed).select("complaint_id")
    respelt = lookup_join(silver.select("complaint_id", "company_raw"), renamed, ["company_raw"], "inner").select("complaint_id")
    ids = materialise(held.unionByName(left).unionByName(respelt).distinct(), "affected_ids")
    fresh = by_month(_silver_rows(rows, lookup, seeds, ids))
    fresh = materialise(fresh, "affected_rows")
    months = silver.join(ids, "complaint_id", "left_semi").select(MONTH).unionByName(fresh.select(MONTH)).distinct()
    months = materialise(months, "affected_months")
    # one row per month; the filter prunes the folders of all others
    stay = silver.join(F.broadcast(months), MONTH, "left_semi").join(ids, "complaint_id", "left_anti")
    parts = overwrite_parts(stay.select(*schema.names).unionByName(fresh), path, MONTH, months)
    _written(materialise(lookup, "lookup_now"), lookup_path)
    return parts


def batch_counts(rows: DataFrame, keys: Sequence[str], batch: str = "_batch_id") -> DataFrame:
    return rows.groupBy(F.col(batch).cast("string").alias("batch"), *keys).agg(F.count("*").alias("n"))


def write_summary(rows: DataFrame, keys: Sequence[str], path: str, batch: str = "_batch_id") -> DataFrame:
    """Counts per ``keys`` over all rows, and beside them the counts of every batch."""
    counts = batch_counts(rows, keys, batch)
    counts.write.mode("overwrite").partitionBy("batch").parquet(f"{path}/batches")
    stored = rows.sparkSession.read.schema(counts.schema).parquet(f"{path}/batches")
    total = stored.groupBy(*keys).agg(F.sum("n").alias("n"))
    return _written(total, f"{path}/total")


def refresh_summary(rows: DataFrame, batches: Sequence[str], keys: Sequence[str], path: str, batch: str = "_batch_id") -> DataFrame:
    """The summary after ``batches`` were replaced, added or dropped: what they counted before is taken back,
    what they count now is added. Only rows of these batches are read; keys that come to 0 disappear."""
    spark = rows.sparkSession
    chosen = list(batches)
    now = materialise(batch_counts(rows.filter(F.col(batch).cast("string").isin(chosen)), keys, batch), "counts_now")
    stored = spark.read.schema(now.schema).parquet(f"{path}/batches")
    gone = stored.filter(F.col("batch").isin(chosen)).withColumn("n", -F.col("n"))
    delta = now.unionByName(gone.select(*now.columns)).drop("batch")
    total = spark.read.parquet(f"{path}/total")
    summed = total.unionByName(delta.select(*total.columns)).groupBy(*keys).agg(F.sum("n").alias("n")).filter("n <> 0")
    summed = materialise(summed, "summary_now")  # reads what is replaced next
    overwrite_parts(now, f"{path}/batches", "batch", spark.createDataFrame([(b,) for b in chosen], "batch string"))
    return _written(summed, f"{path}/total")

