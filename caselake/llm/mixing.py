"""Mixing sources to target weights by systematic sampling (operator 5), DataFrame operations only.

Every source gets a target number of words. A document's expected copies are target / size of its
source. Within a source the expected copies are summed up in a fixed order, one random offset is
added, and a document is emitted once per integer boundary that its own interval crosses.

The order puts documents of similar size next to each other, so that the taken words follow the
target and not only the taken documents. No task sees a whole source: a source is cut into cells
(size class, hash bucket); every cell is ranked on its own and starts at the sum of the cells
before it. Buckets are as many as the largest cell needs for about ``cell_rows`` documents each.

Defined results: a null text has size 0; a null source is a source of its own, last in the order;
a source without words has target 0 and gives no document; an empty table gives no rows; repeated
rows are documents of their own; other columns, also with the names used here, are carried along
unread inside ``row``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselake.llm.registry import query, table

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = "mix-1"
CELL_ROWS = 50_000
WORD = r"[^\x20\x09-\x0D]+"


def _unit(text: Column, digits: int = 7) -> Column:
    """A number in [0, 1) from the text's digest."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("double") / F.lit(float(16**digits))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """sizes (no_src, src, source_size) -> the same with ``target``.

    One row per source: shares by weight of all words, cut at ``most`` times the source, the excess
    shared again by weight. With sources in the order of cap / weight, the capped ones come first,
    so the level at which the sharing ends is read from two running sums instead of a loop. These
    windows see one row per source, never documents.
    """
    place = F.row_number().over(Window.orderBy("no_src", "src"))
    by_place = F.element_at(F.array(*[F.lit(w) for w in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("w", by_place.cast("long"))
    cap, order = F.lit(most) * F.col("source_size"), ["ratio", "no_src", "src"]
    full = ranked.withColumn("ratio", cap.cast("double") / F.col("w"))
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = full.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))).alias("rest"),
        F.sum("w").over(onward).alias("w_rest"),
    )
    level = F.col("rest").cast("double") / F.col("w_rest")
    free = cap.cast("double") >= level * F.col("w")
    levelled = summed.withColumn("level", F.min(F.when(free, F.struct("ratio", "no_src", "src", level.alias("v")))).over(everything))
    target = F.least(cap.cast("double"), F.col("level.v") * F.col("w"))
    return levelled.select("no_src", "src", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    keep: Sequence[str],
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: str = SEED,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """row (struct of ``keep``), size, source_size, target, copies: one row per document."""
    name = F.coalesce(F.col(f"`{source}`").cast("string"), F.lit(""))
    size = F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        F.col(f"`{source}`").isNull().alias("no_src"),
        name.alias("src"),
        size.alias("size"),
        F.md5(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("null"))).alias("h"),
    )
    bits = F.bin("size")
    rows = rows.withColumn("size_class", F.length(bits) * 8 + F.conv(F.substring(bits, 1, 3), 2, 10).cast("int"))
    classes = rows.groupBy("no_src", "src", "size_class").agg(F.count("*").alias("n"))
    largest = classes.agg(F.max("n")).first()[0] or 1
    buckets = -(-largest // cell_rows)
    rows = rows.withColumn("bucket", F.conv(F.substring("h", 1, 7), 16, 10).cast("long") % buckets)

    cell = ["no_src", "src", "size_class", "bucket"]
    cells = rows.groupBy(*cell).agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    targets = source_targets(cells.groupBy("no_src", "src").agg(F.sum("words").alias("source_size")), weights, most)
    earlier = Window.partitionBy("no_src", "src").orderBy("size_class", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(*cell, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    starts = starts.join(targets, ["no_src", "src"])

    place = F.col("start") + F.row_number().over(Window.partitionBy(*cell).orderBy("size", "h"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = _unit(F.concat(F.lit(f"{seed}:"), F.col("no_src").cast("string"), F.lit(":"), F.col("src")))
    crossed = F.floor(F.col("place") * rate + offset) - F.floor((F.col("place") - 1) * rate + offset)
    return (
        rows.join(starts, cell)
        .withColumn("place", place)
        .select("row", "size", "source_size", "target", crossed.cast("long").alias("copies"))
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: the columns of ``docs``, each document as often as it is taken."""
    mixed = mix_sources(docs, docs.columns)
    taken = mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return taken.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, 'null')) AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM s),
p AS (
  SELECT *, 3.0 * source_size / w AS ratio,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3.0 * source_size / w, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / sum(w) OVER (ORDER BY 3.0 * source_size / w, source NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM r),
l AS (SELECT level AS v FROM p WHERE (3 * source_size)::DOUBLE >= level * w ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, v * w) AS target FROM p, l),
c AS (SELECT *, length(bin(size)) * 8 + ('0b' || substr(bin(size), 1, 3))::INT AS size_class FROM d),
m AS (SELECT max(n) AS n FROM (SELECT count(*) AS n FROM c GROUP BY source, size_class)),
q AS (
  SELECT c.*, row_number() OVER (PARTITION BY source
           ORDER BY size_class, ('0x' || substr(h, 1, 7))::BIGINT % ceil(m.n / 50000.0)::BIGINT, size, h) AS place
  FROM c, m),
x AS (
  SELECT q.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('mix-1:' || (q.source IS NULL)::VARCHAR || ':' || coalesce(q.source, '')), 1, 7))::BIGINT / 268435456.0::DOUBLE AS u
  FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(place * rate + u) - floor((place - 1) * rate + u)))::BIGINT AS taken
FROM x
"""


@query("op5_mix_sources", OP5_SQL)
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"), ["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
