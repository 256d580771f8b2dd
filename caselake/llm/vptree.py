"""Approximate nearest neighbours with vantage-point trees per shard (operator 2).

Every vector goes to one of the shards by a hash of its id, so shards are even whatever the vectors
are; each holds about ``shard_rows`` vectors and one tree, built by its task and stored as flat
arrays in a table of the shared folder. Queries travel in blocks of ``block_rows``; a task takes one
(shard, block) pair and returns the shard's best for the block, and a ranked window merges shards.

A search first descends to the query's own leaf, which gives a first radius, then walks the tree. A
side is skipped if the triangle inequality, with its lower bound multiplied by ``factor``, puts it
beyond the radius. ``factor`` 1 is exact; larger values skip more and may miss neighbours.

Distances are Euclidean in double precision, summed component by component. Defined results: rows
whose vector is null, empty, zero, of another length than most or holds null or non-finite
components take no part, nor do rows without id; equal distances go by the smaller id; rows that
repeat an id are candidates each, but never of the query with their own id; fewer candidates than
asked give fewer rows; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselake.llm.registry import query, table
from caselake.session import materialise

NEAREST = 10
FACTOR = 4.0  # recall 0.999 on vectors spread evenly in 64 dimensions, where little can be skipped
SHARD_ROWS = 16_384
BLOCK_ROWS = 2_048
LEAF = 128
SLACK = 1e-9  # of rounding


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of a to all rows of b; sums run over the components in order."""
    total = np.zeros((len(a), len(b)))
    for k in range(a.shape[1]):
        total += (a[:, k, None] - b[None, :, k]) ** 2
    return np.sqrt(total)


class Tree:
    """Rows in tree order; node k covers rows[first[k]:last[k]]; its vantage point is the first of them.

    Inner nodes keep the distance ranges of both halves to the vantage point.
    """

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf: int = LEAF):
        order = np.lexsort((*x.T[:1], ids))
        self.ids, self.x = ids[order], x[order]
        self.nodes: list[tuple] = []  # first, last, inner child, outer child, (lo, hi) of inner, (lo, hi) of outer
        if len(ids):
            self._grow(0, len(ids), leaf)
        self.square = (self.x**2).sum(axis=1)

    def _grow(self, a: int, b: int, leaf: int) -> int:
        k = len(self.nodes)
        self.nodes.append((a, b, -1, -1, 0.0, 0.0, 0.0, 0.0))
        if b - a <= leaf:
            return k
        # the row farthest from the first one lies at the rim, which makes thinner shells
        far = a + int(distances(self.x[a : a + 1], self.x[a:b])[0].argmax())
        self.x[[a, far]], self.ids[[a, far]] = self.x[[far, a]], self.ids[[far, a]]
        d = distances(self.x[a : a + 1], self.x[a + 1 : b])[0]
        order = np.argsort(d, kind="stable")
        self.x[a + 1 : b], self.ids[a + 1 : b], d = self.x[a + 1 : b][order], self.ids[a + 1 : b][order], d[order]
        half = len(d) // 2
        inner, outer = self._grow(a + 1, a + 1 + half, leaf), self._grow(a + 1 + half, b, leaf)
        self.nodes[k] = (a, b, inner, outer, d[0], d[half - 1], d[half], d[-1])
        return k


class Search:
    """The nearest rows of one tree for a block of queries."""

    def __init__(self, tree: Tree, ids: np.ndarray, x: np.ndarray, nearest: int, factor: float):
        self.tree, self.qid, self.q, self.factor = tree, ids, x, factor
        self.d = np.full((len(x), nearest), np.inf)
        self.id = np.full((len(x), nearest), np.iinfo(np.int64).max)
        self.compared, self.square = 0, (x**2).sum(axis=1)
        if tree.nodes and len(x):
            everyone = np.arange(len(x))
            self._home(0, everyone)
            self.radius = self.d[:, -1].copy()
            self.d[:], self.id[:] = np.inf, np.iinfo(np.int64).max
            self._walk(0, everyone)

    def _take(self, rows: np.ndarray, a: int, b: int) -> None:
        """Rows [a, b) of the tree as candidates of these queries."""
        if not len(rows):
            return
        q, x, k = self.q[rows], self.tree.x[a:b], self.d.shape[1]
        self.compared += len(q) * len(x)
        # squares by a matrix product decide who may be among the nearest; who may is measured exactly
        square = self.square[rows, None] + self.tree.square[None, a:b] - 2 * (q @ x.T)
        slack = 1e-9 * (self.square[rows] + self.tree.square[a:b].max())
        limit = self.d[rows, -1] ** 2 + slack
        if b - a > k + 1:  # one of them may be the query itself
            limit = np.minimum(limit, np.partition(square, k, axis=1)[:, k] + 2 * slack)
        r, c = np.nonzero(square <= limit[:, None])
        other = self.tree.ids[a:b][c] != self.qid[rows[r]]
        r, c = r[other], c[other]
        if not len(r):
            return
        touched, place, sizes = np.unique(r, return_inverse=True, return_counts=True)
        column = np.arange(len(r)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        d = np.full((len(touched), sizes.max()), np.inf)
        ids = np.full(d.shape, np.iinfo(np.int64).max)
        d[place, column] = np.sqrt(np.cumsum((q[r] - x[c]) ** 2, axis=1)[:, -1])
        ids[place, column] = self.tree.ids[a:b][c]
        rows = rows[touched]
        d, ids = np.concatenate([self.d[rows], d], axis=1), np.concatenate([self.id[rows], ids], axis=1)
        best = np.lexsort((ids, d), axis=1)[:, :k]
        self.d[rows], self.id[rows] = np.take_along_axis(d, best, 1), np.take_along_axis(ids, best, 1)

    def _home(self, k: int, rows: np.ndarray) -> None:
        a, b, inner, outer, _, hi, lo, _ = self.tree.nodes[k]
        if inner < 0:
            return self._take(rows, a, b)
        if len(rows):
            near = distances(self.q[rows], self.tree.x[a : a + 1])[:, 0] <= (hi + lo) / 2
            self._home(inner, rows[near])
            self._home(outer, rows[~near])

    def _walk(self, k: int, rows: np.ndarray) -> None:
        a, b, inner, outer, *spans = self.tree.nodes[k]
        if not len(rows):
            return
        if inner < 0:
            return self._take(rows, a, b)
        d = distances(self.q[rows], self.tree.x[a : a + 1])
        self._take(rows, a, a + 1)
        for child, lo, hi in ((inner, *spans[:2]), (outer, *spans[2:])):
            bound = np.maximum(0, np.maximum(lo - d[:, 0], d[:, 0] - hi))
            limit = np.minimum(self.radius[rows], self.d[rows, -1])
            self._walk(child, rows[bound * self.factor <= limit * (1 + SLACK) + SLACK])


def usable(vector: Column) -> Column:
    v = vector.cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda c: c != 0)


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    nearest: int = NEAREST,
    factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``nearest`` of ``vectors`` for each row of ``queries``."""
    spark = vectors.sparkSession
    v = F.col(f"`{vector}`")
    clean = lambda df: df.filter(usable(v) & F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").cast("long").alias("id"), v.cast("array<double>").alias("v"))
    rows, asked = clean(vectors), clean(queries)
    by_length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if by_length is None:
        return empty
    rows, asked = rows.filter(F.size("v") == by_length["n"]), asked.filter(F.size("v") == by_length["n"])
    shards, blocks = -(-by_length["count"] // shard_rows), -(-asked.count() // block_rows)
    if not blocks:
        return empty

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        x = rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
        tree = Tree(rows["id"].to_numpy(), x)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "tree": pa.array([pickle.dumps(tree, 5)], pa.binary())})

    own = F.pmod(F.xxhash64("id", "v"), F.lit(shards))
    trees = rows.select(own.alias("shard"), "id", "v").groupBy("shard").applyInArrow(build, "shard long, tree binary")
    trees = materialise(trees, "trees")

    pair = "shard long, block long"
    to_all = lambda df, n, name: df.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    asked = to_all(asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))), shards, "shard")
    trees = to_all(trees, blocks, "block")

    def search(tree: pa.Table, block: pa.Table) -> pa.Table:
        if not tree.num_rows or not block.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        q = block["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(block.num_rows, -1)
        found = Search(pickle.loads(tree["tree"][0].as_py()), block["id"].to_numpy(), q, nearest, factor)
        real = np.isfinite(found.d)
        ids = np.broadcast_to(found.qid[:, None], found.d.shape)
        return pa.table({"query_id": ids[real], "vec_id": found.id[real], "score": found.d[real]})

    best = trees.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


OP2_SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
d AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         sqrt(list_reduce(list_prepend(0::DOUBLE, list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i] - v.v[i]) * (q.v[i] - v.v[i]))), lambda a, b: a + b)) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d) WHERE rank <= 10
"""


@query("op2_vp_neighbours", OP2_SQL)
def op2_vp_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.filter(F.col("vec_id") % 100 == 0))
