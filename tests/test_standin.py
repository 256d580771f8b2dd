import pytest
from pyspark.sql import functions as F

from caselake.catalog.standin import raw_complaints

SHUFFLED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def no_broadcast(spark):
    before = {key: spark.conf.get(key, None) for key in SHUFFLED}
    for key, value in SHUFFLED.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _tables(spark, folder):
    ids = spark.range(1, 201)
    when = F.lit("1996-03-04").cast("timestamp")
    tables = {
        "customer": ids.select(F.col("id").alias("c_custkey"), F.lit(1).alias("c_nationkey")),
        "part": ids.select(
            F.col("id").alias("p_partkey"), F.lit("cold bolt").alias("p_name"), F.lit("Brand#1").alias("p_brand"),
            F.lit("TIN").alias("p_type"), F.lit(3).alias("p_size"),
        ),
        "orders": ids.select(
            F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
            when.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
        ),
        # lines of one order name many parts; some have no supplier or line number
        "lineitem": spark.range(1200).select(
            (F.col("id") % 200 + 1).alias("l_orderkey"), (F.col("id") % 199 + 1).alias("l_partkey"),
            F.when(F.col("id") != 11, F.col("id") % 50).alias("l_suppkey"),
            F.when(F.col("id") != 12, (F.col("id") / 200).cast("int") + 1).alias("l_linenumber"),
            F.lit("A").alias("l_returnflag"), F.lit("F").alias("l_linestatus"), when.alias("l_shipdate"),
        ),
    }
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")


def test_rows_of_one_id_come_out_of_one_task(spark, tmp_path, no_broadcast):
    _tables(spark, tmp_path)
    raw = raw_complaints(spark, str(tmp_path)).select(F.regexp_replace("complaint_id", "[ x]", "").alias("id"), F.spark_partition_id().alias("task"))
    tasks = raw.filter("id <> ''").groupBy("id").agg(F.count_distinct("task").alias("n"))
    assert tasks.count() > 100
    assert tasks.filter("n > 1").count() == 0


def test_texts_of_a_part_stay_without_supplier_or_line_number(spark, tmp_path):
    _tables(spark, tmp_path)
    raw = raw_complaints(spark, str(tmp_path))
    assert raw.count() == 1200
    assert raw.filter("company IS NULL OR product IS NULL").count() == 0
    assert raw.filter("consumer_complaint_narrative = 'about cold bolt, TIN'").count() == 399
