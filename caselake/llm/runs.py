"""Periodic runs of words by recompression (operator 13).

A run is a stretch of words with smallest period q that is at least twice as long as q (and at least
``LEAST`` words) and that no neighbouring word extends. Candidates come from a harmonic grid: for every
period p the places 0, p, 2p, ... of a text (n log n pairs in all). Within a run of period p the
places that equal the place p further on are at least max(p, LEAST - p) in a row, so one of them is on
the grid, and three equal places follow or precede it. What passes this is extended exactly, to both
sides, by queries on the run-length grammar of recompression.py; no suffix array is built. A
stretch found under several periods keeps the smallest.

Texts are independent of each other: no shuffle, no state between tasks. A task takes the texts of an
Arrow batch in chunks of ``CHUNK_WORDS`` words under one grammar (one text is never cut, so a task
needs memory for its longest text).

Defined results: a null or empty text has no words and no runs; ties between runs cannot occur (no two
runs share start and period); repeated rows give repeated results; null ids and further columns are
handed on; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake.llm.recompression import Grammar
from caselake.llm.registry import query, table

LEAST = 12
CHUNK_WORDS = 300_000
TABLE_WORDS = 1 << 16  # longer texts walk the grid period by period
Runs = tuple[np.ndarray, np.ndarray, np.ndarray]  # starts, ends, periods
RUN_TYPE = T.ArrayType(T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")]), False)
_NONE = np.zeros(0, dtype=np.int64)


class _Grid:
    """Pairs (m - p, m), p dividing m, ordered by m: those of a shorter text are a prefix."""

    def __init__(self):
        self.size, self.left, self.right, self.until = 0, _NONE, _NONE, np.zeros(1, dtype=np.int64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            size = min(TABLE_WORDS, max(1024, 1 << (n - 1).bit_length()))
            period = np.repeat(np.arange(1, size), (size - 1) // np.arange(1, size))
            order = np.arange(len(period)) - np.repeat(np.cumsum((size - 1) // np.arange(1, size)) - (size - 1) // np.arange(1, size), (size - 1) // np.arange(1, size))
            right = period * (order + 1)
            sort = np.argsort(right, kind="stable")
            self.right, self.left = right[sort].astype(np.int32), (right - period)[sort].astype(np.int32)
            self.until = np.searchsorted(self.right, np.arange(size + 1))
            self.size = size
        end = self.until[n]
        return self.left[:end], self.right[:end]


_grid = _Grid()


def _candidates(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grid places i and periods p of one text that may lie in a run."""
    n = len(words)
    if n < LEAST:
        return _NONE, _NONE
    if n <= TABLE_WORDS:
        left, right = _grid.upto(n)
        hit = np.flatnonzero(words[left] == words[right])
        i, j = left[hit].astype(np.int64), right[hit].astype(np.int64)
    else:
        found = []
        for p in range(1, n // 2 + 1):
            at = words[::p]
            k = np.flatnonzero(at[1:] == at[:-1])
            if len(k):
                found.append((k * p, k * p + p))
        i, j = (np.concatenate(c) for c in zip(*found)) if found else (_NONE, _NONE)
    keep = 2 * (j - i) <= n
    i, j = i[keep], j[keep]
    after, before = j + 3 < n, i >= 3
    for k in (1, 2, 3):
        after &= words[np.minimum(i + k, n - 1)] == words[np.minimum(j + k, n - 1)]
        before &= words[np.maximum(i - k, 0)] == words[np.maximum(j - k, 0)]
    keep = after | before
    return i[keep], (j - i)[keep]


def find_runs(texts: Sequence[np.ndarray]) -> list[Runs]:
    """For each sequence of word numbers (from 0) its runs, ordered by start, then period."""
    out: list[Runs] = [(_NONE, _NONE, _NONE)] * len(texts)
    asked = [(k, *_candidates(w)) for k, w in enumerate(texts)]
    asked = [a for a in asked if len(a[1])]
    if not asked:
        return out
    separators = len(asked) + 1
    parts, at = [np.zeros(1, dtype=np.int64)], []
    place = 1
    for m, (k, _, _) in enumerate(asked):
        parts += [texts[k].astype(np.int64) + separators, np.array([m + 1])]
        at.append(place)
        place += len(texts[k]) + 1
    symbols = np.concatenate(parts)
    grammar = Grammar(symbols, symbols < separators)
    counts = [len(i) for _, i, _ in asked]
    owner = np.repeat(np.arange(len(asked)), counts)
    base = np.repeat(np.array(at), counts)
    x = np.concatenate([i for _, i, _ in asked]) + base
    p = np.concatenate([q for _, _, q in asked])
    end = x + p + grammar.extensions(x, x + p, 1)
    start = x - grammar.extensions(x - 1, x + p - 1, -1)
    long = end - start >= np.maximum(LEAST, 2 * p)
    start, end, p, owner, base = start[long] - base[long], end[long] - base[long], p[long], owner[long], base[long]
    order = np.lexsort((p, end, start, owner))
    start, end, p, owner = start[order], end[order], p[order], owner[order]
    new = np.ones(len(p), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, p, owner = start[new], end[new], p[new], owner[new]
    order = np.lexsort((p, start, owner))
    start, end, p, owner = start[order], end[order], p[order], owner[order]
    cuts = np.searchsorted(owner, np.arange(len(asked) + 1))
    for m, (k, _, _) in enumerate(asked):
        one = slice(cuts[m], cuts[m + 1])
        out[k] = (start[one], end[one], p[one])
    return out


def repeats(n: int, runs: Runs) -> np.ndarray:
    """True for words that lie in a run after its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    starts, ends, periods = runs
    np.add.at(change, starts + periods, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:n]) > 0


def _annotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        split = [(t or "").encode().split() for t in batch.column(1).to_pylist()]  # at ASCII blanks
        a = size = 0
        for b in range(1, len(split) + 1):
            size += len(split[b - 1])
            if size < CHUNK_WORDS and b < len(split):
                continue
            numbers: dict[bytes, int] = {}
            coded = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in ws), np.int64, len(ws)) for ws in split[a:b]]
            found = find_runs(coded)
            lists, collapsed = [], []
            for ws, runs in zip(split[a:b], found):
                lists.append([{"start": s, "length": e - s, "period": q} for s, e, q in zip(*(c.tolist() for c in runs))])
                gone = repeats(len(ws), runs) if len(runs[0]) else None
                collapsed.append(b" ".join(ws if gone is None else [w for w, g in zip(ws, gone.tolist()) if not g]).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[a:b],
                    pa.array([len(ws) for ws in split[a:b]], pa.int64()),
                    pa.array(lists, pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
                    pa.array(collapsed, pa.string()),
                ],
                ["row", "n_words", "runs", "collapsed"],
            )
            a, size = b, 0


def periodic_runs(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """row (a struct of the ``keep`` columns), n_words, runs (start, length, period by start, then
    period) and collapsed: the words without the repeats of any run, joined by one blank."""
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType(
        [given.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("runs", RUN_TYPE), T.StructField("collapsed", T.StringType())]
    )
    return given.mapInArrow(_annotate, schema)


def with_planted_tails(docs: DataFrame) -> DataFrame:
    """doc_id, text: in the texts of every tenth hash of the id, the tail repeats a few words."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words")
    placed = cut.withColumns({"n": n, "a": F.when(n > 0, (F.col("g") % n).cast("int"))})
    period: Column = F.lit(1) + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)).cast("int")
    placed = placed.withColumn("p", period)
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    planted = F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), F.lit(1), F.col("n"))
    return placed.select("doc_id", F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_tails(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs(docs, ["doc_id"])
    by_size = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return found.withColumn("best", by_size).select(
        "row.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
