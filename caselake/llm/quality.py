"""Quality classifier: histogram gradient-boosted trees over document statistics (operator 9).

Every text is turned into a row of statistics (case, punctuation, repetition, word and line shapes);
neither labels nor lang, source or doc_id are among them. The trees are fitted on the driver on at
most ``TRAIN_ROWS`` labelled documents (those with the smallest md5 of their id), each boosting
round on histograms of binned statistics. The fitted trees are complete binary trees flattened into
arrays, so a batch of documents descends all trees at once with numpy indexing.

Rows whose crc32(doc_id as text) mod 5 is 0 are held out from fitting.

Defined results: null and empty texts have all statistics 0 and get that row's score; a null doc_id
is never learnt from and not held out; without labels of both kinds every score is the labels' mean
(0.5 without any); repeated labels of an id count once, the lower one; of documents that
repeat a labelled id three are learnt from; very long texts are read whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake.llm.registry import query, table, tidy

TRAIN_ROWS = 20_000
ROWS_PER_ID = 3
CUT = 0.3
_UPPER, _LOWER, _DIGIT = (bytes(range(a, b)) for a, b in ((65, 91), (97, 123), (48, 58)))
_MARKS = ("!", "?", ".", ",", "|", "#", "$", "%", "&", "*", "_", "{", "<", "/", ":", "http", "...", "\t")
STATISTICS = (
    "log_chars", "log_words", "lines_per_word", "word_length", "longest_word", "upper_words", "upper", "lower", "digits",
    "beyond_ascii", "distinct_words", "top_word", "same_neighbours", "distinct_pairs", "distinct_lines", "chars_per_line",
    "first_is_upper", *(f"mark {m}" for m in _MARKS),
)


def statistics(text: str | None) -> list[float]:
    """The row of statistics of a whole text."""
    words = text.split() if text else []
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    raw, chars = text.encode(), len(text)
    lines = text.split("\n")
    without = lambda letters: (len(raw) - len(raw.translate(None, letters))) / len(raw)
    pairs = set(zip(words, islice(words, 1, None)))
    return [
        np.log1p(chars),
        np.log1p(n),
        len(lines) / n,
        sum(map(len, words)) / n,
        np.log1p(max(map(len, words))),
        sum(map(str.isupper, words)) / n,
        without(_UPPER),
        without(_LOWER),
        without(_DIGIT),
        1 - chars / len(raw),
        len(set(words)) / n,
        max(Counter(words).values()) / n,
        sum(map(eq, words, islice(words, 1, None))) / n,
        (len(pairs) + 1) / n,
        len(set(lines)) / len(lines),
        np.log1p(chars / len(lines)),
        float(text[0].isupper()),
        *(text.count(m) / n for m in _MARKS),
    ]


@dataclass
class Trees:
    """Complete binary trees of one depth: node i has the children 2 i + 1 and 2 i + 2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # the same
    value: np.ndarray  # trees x leaves

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(self.feature):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        inner = self.feature.shape[1]
        tree, row = np.arange(len(self.feature))[None, :], np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.feature)), dtype=np.int64)
        while node[0, 0] < inner if len(x) else False:
            right = x[row, self.feature[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        total = self.base + self.value[tree, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, ridge: float = 1.0,
    least: float = 1.0, balance: float = 0.5,
) -> Trees:
    """Boosted trees for the logistic loss, grown level by level from histograms.

    Rows of the rarer class weigh more, by the classes' ratio to the power ``balance``. A leaf holds at
    least a weight (second derivative) of ``least``, or a quarter of the rarer class's if that is less, so
    that a few dozen labels of either kind can still be told apart.
    """
    if not len(y) or y.min() == y.max():
        mean = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
        empty = np.zeros((0, 0))
        return Trees(float(np.log(mean / (1 - mean))), empty.astype(int), empty, empty)
    n, wide = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(wide)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    cell = binned + np.arange(wide) * bins
    rare = y == (y.mean() < 0.5)
    weight = np.where(rare, ((~rare).sum() / rare.sum()) ** balance, 1.0)
    mean, inner = np.average(y, weights=weight), 2**depth - 1
    least = min(least, 0.25 * weight[rare].sum() * mean * (1 - mean))
    base = float(np.log(mean / (1 - mean)))
    margin = np.full(n, base)
    feature, threshold, value = np.zeros((trees, inner), int), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (y - p), weight * p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = ((node - first) * (wide * bins))[:, None] + cell
            summed = lambda w: np.bincount(at.ravel(), np.repeat(w, wide), minlength=width * wide * bins).reshape(width, wide, bins).cumsum(2)
            gl, hl = summed(g), summed(h)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            gain[(hl < least) | (ht - hl < least)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for k, b in enumerate(best.tolist()):
                f, j = divmod(b, bins)
                if gain[k, f, j] > 1e-6 and j < len(edges[f]):
                    feature[t, first + k], threshold[t, first + k] = f, edges[f][j]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        leaf = node - inner
        value[t] = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        margin += value[t, leaf]
    return Trees(base, feature, threshold, value)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, key: str = "doc_id", per_class: bool = False) -> DataFrame:
    """doc_id, label, text of at most ``most`` labelled rows (of each label if ``per_class``) outside the
    held-out part: those with the smallest md5 of the id. The sample's bound is what may be broadcast. Of
    documents that share a labelled id, ``ROWS_PER_ID`` are taken."""
    known = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("y")).filter(F.col("y").isin(0, 1) & F.col("id").isNotNull())
    known = known.filter(~held_out(F.col("id"))).groupBy("id").agg(F.min("y").alias("y"))
    first = lambda rows: rows.orderBy(F.md5(F.col("id").cast("string")), "id").limit(most)
    sample = first(known.filter("y = 0")).unionByName(first(known.filter("y = 1"))) if per_class else first(known)
    known = docs.join(F.broadcast(sample), docs[key] == F.col("id"))
    of_id = Window.partitionBy("id").orderBy(F.xxhash64(*docs.columns))
    return known.withColumn("_n", F.row_number().over(of_id)).filter(F.col("_n") <= ROWS_PER_ID).drop("_n")


def fit_quality(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS, key: str = "doc_id", text: str = "text") -> Trees:
    narrow = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("t"))
    sample = labelled_sample(narrow, labels, "quality", most).select("y", "t", F.md5(F.concat_ws("|", "doc_id", "t")).alias("place"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array([statistics(t) for t in b.column(1).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), x, b.column(2)], ["y", "x", "place"])

    got = sample.mapInArrow(tidy(rows), "y int, x array<double>, place string").toArrow().sort_by("place")
    x = np.array(got["x"].to_pylist(), dtype=np.float64).reshape(-1, len(STATISTICS))
    return fit_trees(x, got["y"].to_numpy().astype(np.float64))


def scored(docs: DataFrame, keep: Sequence[str], score: Callable[[list], np.ndarray], text: str = "text") -> DataFrame:
    """row (struct of ``keep``) and the score of every whole text."""
    kept = T.StructField("row", T.StructType([docs.schema[c] for c in keep]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score(b.column(1).to_pylist()), pa.float64())], ["row", "score"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("t"))
    return rows.mapInArrow(tidy(run), T.StructType([kept, T.StructField("score", T.DoubleType())]))


def quality_scores(docs: DataFrame, trees: Trees, keep: Sequence[str], text: str = "text") -> DataFrame:
    def score(texts: list) -> np.ndarray:
        return trees.scores(np.array([statistics(t) for t in texts], dtype=np.float64).reshape(-1, len(STATISTICS)))

    return scored(docs, keep, score, text)


def good_documents(docs: DataFrame, labels: DataFrame, cut: float = CUT, text: str = "text") -> DataFrame:
    """The documents, unchanged, without those that score below ``cut``."""
    kept = quality_scores(docs, fit_quality(docs, labels, text=text), docs.columns, text).filter(F.col("score") >= cut)
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = quality_scores(docs, fit_quality(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return scores.select(
        "row.doc_id",
        held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
