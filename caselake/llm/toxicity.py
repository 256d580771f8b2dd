"""Toxicity by a classifier chain (operator 3).

Categories are predicted one after the other, each by a logistic model over hashed words and word
beginnings plus the log-odds of all earlier categories; the last link is the overall label. The
probabilities that later links are trained on are out-of-fold: predicted by models that have not
seen the row. The given labels only say toxic or not, so the earlier categories are trained on weak
labels: a toxic row that holds one of the category's seed words.

Fitting uses at most ``TRAIN_ROWS`` rows per label outside the held-out fifth (crc32(doc_id) mod 5 is
0); scoring covers every whole text.

Defined results: null and empty texts hold no words and score the models' intercepts; without labels
of both kinds nothing is toxic; repeated rows score alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.decontamination import words_of
from caselake.llm.quality import held_out, labelled_sample
from caselake.llm.registry import query, table

TRAIN_ROWS = 4_000  # per label
SPACE = 1 << 18
FEATURES = 2_048
FOLDS = 4
CUT = 0.5
OVERALL = "toxic"
SEEDS = {
    "insult": ("idiot", "moron", "stupid", "clown", "loser"),
    "contempt": ("worthless", "pathetic", "trash"),
    "disgust": ("scum", "disgusting"),
}


def features(text: str | None) -> np.ndarray:
    """Hashed distinct words, and the beginnings of longer ones."""
    words = set(words_of(text))
    starts = {b"^" + w[:n] for n in (4, 5) for w in words if len(w) > n}
    return np.unique(np.fromiter(map(crc32, words | starts), np.int64) & (SPACE - 1)) if words else np.zeros(0, np.int64)


class Link:
    """Logistic model over sparse 0/1 columns and a few dense ones."""

    def __init__(self, columns: list[np.ndarray], dense: np.ndarray, y: np.ndarray, width: int, rounds: int = 150, ridge: float = 1.0):
        sizes = np.array([len(c) for c in columns], dtype=np.int64)
        flat, row = np.concatenate([*columns, np.zeros(0, np.int64)]), np.repeat(np.arange(len(y)), sizes)
        self.w, self.v, self.b = np.zeros(width), np.zeros(dense.shape[1]), float(np.log((y.mean() + 1e-3) / (1.001 - y.mean())))
        # Adam on the whole sample; class weights keep rare categories audible
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-3), 0.5 / max(1 - y.mean(), 1e-3))
        state = [np.zeros(width + dense.shape[1] + 1) for _ in range(2)]
        for k in range(1, rounds + 1):
            margin = np.bincount(row, self.w[flat], len(y)) + dense @ self.v + self.b
            g = weight * (1 / (1 + np.exp(-margin)) - y) / len(y)
            slope = np.concatenate([np.bincount(flat, g[row], width) + ridge * self.w / len(y), dense.T @ g + ridge * self.v / len(y), [g.sum()]])
            state[0] = 0.9 * state[0] + 0.1 * slope
            state[1] = 0.99 * state[1] + 0.01 * slope**2
            step = 0.1 * (state[0] / (1 - 0.9**k)) / (np.sqrt(state[1] / (1 - 0.99**k)) + 1e-8)
            self.w, self.v, self.b = self.w - step[:width], self.v - step[width:-1], self.b - step[-1]

    def log_odds(self, columns: list[np.ndarray], dense: np.ndarray) -> np.ndarray:
        sizes = np.array([len(c) for c in columns], dtype=np.int64)
        flat, row = np.concatenate([*columns, np.zeros(0, np.int64)]), np.repeat(np.arange(len(sizes)), sizes)
        return np.clip(np.bincount(row, self.w[flat], len(sizes)) + dense @ self.v + self.b, -20, 20)


class Chain:
    def __init__(self, hashed: list[np.ndarray], targets: dict[str, np.ndarray], fold: np.ndarray):
        self.names = list(targets)
        self.column = self._selected(hashed, targets)
        columns, n = self._columns(hashed), len(hashed)
        earlier = np.zeros((n, 0))
        self.links: list[Link | None] = []
        for y in targets.values():
            if not n or y.min() == y.max():  # nothing to learn: the category never occurs
                self.links.append(None)
                earlier = np.column_stack([earlier, np.full(n, -20.0)])
                continue
            out_of_fold = np.zeros(n)
            for k in range(FOLDS):
                rest, own = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
                link = Link([columns[i] for i in rest], earlier[rest], y[rest], FEATURES)
                out_of_fold[own] = link.log_odds([columns[i] for i in own], earlier[own])
            self.links.append(Link(columns, earlier, y, FEATURES))
            earlier = np.column_stack([earlier, out_of_fold])

    @staticmethod
    def _selected(hashed: list[np.ndarray], targets: dict[str, np.ndarray]) -> np.ndarray:
        """Hash -> column of the features that differ most between some category and the rest, else -1."""
        sizes = np.array([len(h) for h in hashed], dtype=np.int64)
        flat = np.concatenate([*hashed, np.zeros(0, np.int64)])
        seen, score = np.bincount(flat, minlength=SPACE), np.zeros(SPACE)
        for y in targets.values():
            share = y.mean() if len(y) else 0
            hit = np.bincount(flat, np.repeat(y, sizes), minlength=SPACE)
            score = np.maximum(score, np.abs(hit - seen * share) / np.sqrt(seen * share * (1 - share) + 1))
        score[seen < 3] = 0
        best = np.argsort(-score, kind="stable")[:FEATURES]
        column = np.full(SPACE, -1, dtype=np.int16)
        best = best[score[best] > 0]
        column[best] = np.arange(len(best))
        return column

    def _columns(self, hashed: list[np.ndarray]) -> list[np.ndarray]:
        found = [self.column[h] for h in hashed]
        return [c[c >= 0].astype(np.int64) for c in found]

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        """texts x categories."""
        columns, earlier = self._columns([features(t) for t in texts]), np.zeros((len(texts), 0))
        for link in self.links:
            earlier = np.column_stack([earlier, np.full(len(texts), -20.0) if link is None else link.log_odds(columns, earlier)])
        return 1 / (1 + np.exp(-earlier))


def fit_chain(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS, key: str = "doc_id", text: str = "text") -> Chain:
    narrow = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("t"))
    sample = labelled_sample(narrow, labels, "toxic", most, per_class=True)
    sample = sample.select("y", "t", F.md5(F.concat_ws("|", "doc_id", "t")).alias("place"), (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 % FOLDS).cast("int").alias("fold"))
    seeds = [frozenset(w.encode() for w in words) for words in SEEDS.values()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            marks = [[not s.isdisjoint(words_of(t)) for s in seeds] for t in texts]
            x = pa.array([features(t).astype(np.int32) for t in texts], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), x, pa.array(marks, pa.list_(pa.bool_())), b.column(2), b.column(3)], ["y", "x", "marks", "place", "fold"])

    got = sample.mapInArrow(rows, "y int, x array<int>, marks array<boolean>, place string, fold int").toArrow().sort_by("place")
    y = got["y"].to_numpy().astype(np.float64)
    marks = np.array(got["marks"].to_pylist(), dtype=np.float64).reshape(-1, len(seeds))
    targets = {name: y * marks[:, k] for k, name in enumerate(SEEDS)} | {OVERALL: y}
    hashed = [np.asarray(x.values, dtype=np.int64) for x in got["x"]]
    return Chain(hashed, targets, got["fold"].to_numpy())


def toxicity_scores(docs: DataFrame, chain: Chain, key: str = "doc_id", text: str = "text", cut: float = CUT) -> DataFrame:
    """doc_id, p_<category> for each link of the chain, score (the last one), toxic."""
    names = [f"p_{n}" for n in chain.names if n != OVERALL] + ["score"]
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = chain.probabilities(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(p[:, k]) for k in range(p.shape[1])]], ["doc_id", *names])

    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("t"))
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} double" for n in names)).withColumn("toxic", F.col("score") >= cut)


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = toxicity_scores(docs, fit_chain(docs, table(spark, sf_dir, "labels")))
    return scores.withColumn("held_out", held_out(F.col("doc_id")))
