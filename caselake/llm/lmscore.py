"""Cross-entropy difference of matched n-gram models (operator 1).

Two bigram models, one of the target documents and one of all documents, share the vocabulary, the
order and the smoothing. A document's score is the mean over its words of the target model's loss
minus the background model's: low scores are like the target, and what both find hard cancels out.

All words and their counts are gathered in a table that grows with the corpus. The ``VOCABULARY`` most
frequent words are classes of their own, all others form one more class. Which class follows which is
a bigram model with a table of VOCABULARY squared loss differences; a word of the last class adds the
loss difference of the word within it. That of the ``TIER`` next frequent words is broadcast as well; all
rarer words meet their text by a join on the word (none of them is frequent enough to be a hot key), and
their sum is added per text. No word is left out or taken for another.

Loss of class w after v: -ln((c(v, w) + PRIOR * u(w)) / (c(v) + PRIOR)), with u(w) = (c(w) + 1) / (N + VOCABULARY).
Loss of a word within its class: -ln((c + K) / (C + K * words)) for all documents, and with K times the target's share
of C for the target, so that words seen once or twice say little. Defined results: a null text or one
without words has n_tokens 0 and a null score; without target documents the target model is the uniform
one; repeated rows count and score each; very long texts are scored whole; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.decontamination import words_of
from caselake.llm.jaccard import limited_broadcast
from caselake.llm.registry import query, table
from caselake.session import materialise

VOCABULARY = 2_048
TIER = 200_000
PRIOR = 32.0
K = 1.0
COUNTERS = 400_000  # of one task between two hand-overs
UNKNOWN, START = 0, 1


def word_counts(docs: DataFrame, text: str = "text", target: str = "target") -> DataFrame:
    """w (normalised words), n (occurrences in all documents), m (in target documents)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def part() -> pa.RecordBatch:
            words = list(seen[0].keys() | seen[1].keys())
            m = [seen[1][w] for w in words]
            n = [seen[0][w] + k for w, k in zip(words, m)]
            for c in seen:
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n, pa.int64()), pa.array(m, pa.int64())], ["w", "n", "m"])

        for b in batches:
            for t, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen[wanted].update(words_of(t))
                if len(seen[0]) + len(seen[1]) > COUNTERS:
                    yield part()
        yield part()

    counted = docs.select(F.col(f"`{text}`").alias("t"), F.col(target)).mapInArrow(run, "w binary, n long, m long")
    return counted.groupBy("w").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


class Words:
    """Numbers of the frequent words: classes from 2 on (ties by their bytes), the broadcast tier from ``size``
    on, with the tier's loss differences; ``tail`` is the table (w, d) of all rarer words."""

    def __init__(self, words: DataFrame, size: int, tier: int):
        classes = words.orderBy(F.desc("n"), "w").limit(size - 2).select("w", "n", "m").toArrow()
        self.number = {w: k for k, w in enumerate(classes["w"].to_pylist(), 2)}
        # words of one count stay together: the tier is what occurs at least ``least`` times
        room, least = size - 2 + tier, None
        for r in words.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(room + 1).collect():
            room -= r.words
            if room < 0:
                break
            least = r.n
        often = words.filter(F.col("n") >= least).toArrow() if least else classes.slice(0, 0)  # at most size + ``tier`` rows
        n, m = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("m"), F.lit(0))).first()
        n, m = n - sum(classes["n"].to_pylist()), m - sum(classes["m"].to_pylist())
        share = m / n if n else 0.0  # the target's part of the last class
        kept = [i for i, w in enumerate(often["w"].to_pylist()) if w not in self.number]
        often = often.take(pa.array(kept, pa.int64()))
        self.number |= {w: k for k, w in enumerate(often["w"].to_pylist(), size)}
        count = np.stack([often["n"].to_numpy(), often["m"].to_numpy()]).astype(np.float64)
        self.tier = np.log(share * (count[0] + K)) - np.log(count[1] + K * share) if share else np.zeros(len(kept))
        self.tail = None
        if room < 0 and share:
            rarer = words.filter(F.col("n") < least) if least else words
            self.tail = rarer.select("w", (F.log(share * (F.col("n") + K)) - F.log(F.col("m") + K * share)).alias("d"))


def numbered(texts: list[str | None], number: dict[bytes, int]) -> tuple[list[list[bytes]], list[np.ndarray]]:
    """Words of every text, and their numbers, -1 for those without one."""
    words = [words_of(t) for t in texts]
    sizes = [len(w) for w in words]
    flat = np.fromiter(map(number.get, chain.from_iterable(words), repeat(-1)), np.int64, sum(sizes))
    return words, np.split(flat, np.cumsum(sizes)[:-1]) if sizes else []


def classes_of(numbers: np.ndarray, size: int) -> np.ndarray:
    return np.where((numbers >= 0) & (numbers < size), numbers, UNKNOWN)


def bigrams(words: np.ndarray, size: int) -> np.ndarray:
    """previous word * size + word, for every word of a document."""
    return np.concatenate([[START], words[:-1]]) * size + words if len(words) else words


def bigram_counts(docs: DataFrame, known, size: int, target: str = "target", text: str = "text") -> DataFrame:
    """v, w, n (all documents), m (target documents)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = [bigrams(classes_of(x, size), size) for x in numbered(b.column(0).to_pylist(), known.value)[1]]
            if not pairs:
                continue
            wanted = np.repeat(b.column(1).to_numpy(zero_copy_only=False).astype(bool), [len(p) for p in pairs])
            code, place, n = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
            m = np.bincount(place[wanted], minlength=len(code))
            columns = [code // size, code % size, n, m]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["v", "w", "n", "m"])

    rows = docs.select(F.col(f"`{text}`").alias("t"), F.col(target).alias("target"))
    return rows.mapInArrow(run, "v long, w long, n long, m long").groupBy("v", "w").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def loss_differences(counts: DataFrame, size: int, prior: float) -> np.ndarray:
    """size x size: target loss minus background loss of word w (column) after v (row)."""
    single = counts.groupBy("w").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).collect()  # at most ``size`` rows
    share = np.ones((2, size))
    for r in single:
        share[:, r.w] += r.n, r.m
    share /= share.sum(axis=1, keepdims=True)

    def row(rows: pa.Table) -> pa.Table:
        own = np.zeros((2, size))
        own[:, rows["w"].to_numpy()] = rows["n"].to_numpy(), rows["m"].to_numpy()
        p = np.log((own + prior * share) / (own.sum(axis=1, keepdims=True) + prior))
        return pa.table({"v": rows["v"][:1], "d": pa.array([(p[0] - p[1]).astype(np.float32).tobytes()], pa.binary())})

    out = np.tile((np.log(share[0]) - np.log(share[1])).astype(np.float32), (size, 1))
    for r in counts.groupBy("v").applyInArrow(row, "v long, d binary").toLocalIterator():
        out[r.v] = np.frombuffer(r.d, np.float32)
    return out


def score_documents(
    docs: DataFrame,
    target_ids: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = VOCABULARY,
    prior: float = PRIOR,
    tier: int = TIER,
) -> DataFrame:
    """doc_id, n_tokens, score of every document; ``target_ids`` (one column) names the target documents."""
    spark = docs.sparkSession
    named = target_ids.select(F.col(target_ids.columns[0]).alias("id")).filter("id is not null").distinct().withColumn("target", F.lit(True))
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    marked = rows.join(limited_broadcast(materialise(named, "targets")), F.col("doc_id") == F.col("id"), "left")
    marked = marked.withColumn("target", F.coalesce("target", F.lit(False)))
    words = Words(materialise(word_counts(marked), "words"), size, tier)
    known = spark.sparkContext.broadcast(words.number)
    counts = materialise(bigram_counts(marked, known, size), "bigrams")
    differences = spark.sparkContext.broadcast((loss_differences(counts, size, prior), words.tier))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, tier_difference = differences.value
        flat = table.reshape(-1)
        for b in batches:
            sums, sizes = [], []
            for x in numbered(b.column(1).to_pylist(), known.value)[1]:
                within = tier_difference[x[x >= size] - size].sum() if len(tier_difference) else 0.0
                sums.append(float(flat[bigrams(classes_of(x, size), size)].sum(dtype=np.float64) + within))
                sizes.append(len(x))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64())], ["doc_id", "k", "n_tokens", "total"])

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, found, times, first = [], [], [], []
            for k, ws, x in zip(b.column(1).to_pylist(), *numbered(b.column(0).to_pylist(), known.value)):
                counted = Counter(ws[i] for i in np.flatnonzero(x < 0).tolist())
                found += counted
                times += counted.values()
                keys += [k] * len(counted)
                first += [True, *[False] * (len(counted) - 1)] if counted else []
            columns = [pa.array(keys, pa.int64()), pa.array(found, pa.binary()), pa.array(times, pa.int32()), pa.array(first, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["k", "w", "times", "first"])

    kind = docs.schema[key].dataType.simpleString()
    keyed = rows.withColumn("k", F.xxhash64("doc_id", "text"))
    scored = keyed.mapInArrow(run, f"doc_id {kind}, k long, n_tokens long, total double")
    if words.tail is not None:
        met = keyed.select("text", "k").mapInArrow(rare, "k long, w binary, times int, first boolean").join(words.tail, "w")
        # repeated rows have one key: each of them brings its words once more
        sums = met.groupBy("k").agg((F.sum(F.col("times") * F.col("d")) / F.count_if("first")).alias("more"))
        scored = scored.join(sums, "k", "left").withColumn("total", F.col("total") + F.coalesce("more", F.lit(0.0)))
    return scored.select("doc_id", "n_tokens", F.when(F.col("n_tokens") > 0, F.col("total") / F.col("n_tokens")).alias("score"))


@query("op1_lm_score")
def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents scored against those labelled as good."""
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return score_documents(table(spark, sf_dir, "documents"), good)
