"""Token counts with a two-tier lookup on the map side (operator 8).

Texts are cut into pre-tokens as the tokenizer cuts them. The first tier is a compact table with the
token counts of frequent pre-tokens, broadcast to all workers. What it misses is encoded once per
worker and kept in a cache of bounded size, the second tier. No pre-token is ever shuffled.

The table comes from all documents: every task keeps a bounded summary of its words (counters are
pruned as in Misra and Gries when they grow beyond the bound) and hands on its top words; the sums
of these give the table. It only decides what is looked up and what is encoded, never a result.

Defined results: a null text counts as empty, with 0 bytes and 0 tokens; other columns are ignored.
Pre-tokens longer than ``CACHED_CHARS`` are encoded, not kept.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.registry import query, table

TABLE_WORDS = 50_000  # first tier
TASK_WORDS = 2_000  # handed on by one task
COUNTERS = 200_000  # of one task
CACHED = 200_000  # second tier
CACHED_CHARS = 64
LIMIT = 1024


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Counting:
    """Token counts by pre-token, for byte-level BPE files of the tokenizers library."""

    def __init__(self, path: str, words: list[str]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec["pre_tokenizer"]
        if steps["type"] != "ByteLevel" or steps.get("add_prefix_space") or spec["normalizer"] or spec.get("truncation") or spec.get("padding"):
            raise ValueError(f"{path}: only plain byte-level BPE is cut into pre-tokens here")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that take white space are not handled")
        self.library = Tokenizer.from_file(path)
        # fixed values: the public pattern of byte-level BPE
        self.cut = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
            r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
        ).findall
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        pieces = list(dict.fromkeys(chain.from_iterable(self.cut(x) for w in [*words, "\n"] for x in (w, f" {w}"))))
        self.first = dict(zip(pieces, self._lengths(pieces)))
        self.second: dict[str, int] = {}

    def _lengths(self, pieces: list[str]) -> list[int]:
        return [len(x.ids) for x in self.library.encode_batch(pieces, add_special_tokens=False)]

    def pieces(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens, and the special strings, which the library takes as one token each."""
        if self.special is None or not self.special.search(text):
            return self.cut(text), 0
        parts = self.special.split(text)
        return list(chain.from_iterable(map(self.cut, parts))), len(parts) - 1

    def counts(self, texts: list[str | None]) -> list[int]:
        out, first = [], self.first
        for text in texts:
            if not text:
                out.append(0)
                continue
            pieces, special = self.pieces(text)
            second = self.second
            missing = {p for p in pieces if p not in first and p not in second}
            if missing:
                if len(second) + len(missing) > CACHED:
                    second = self.second = {}
                    missing = {p for p in pieces if p not in first}
                new = list(missing)
                second.update(zip(new, self._lengths(new)))
            total = special
            for p in pieces:
                n = first.get(p)
                total += second[p] if n is None else n
            out.append(total)
            if missing:
                for p in [p for p in missing if len(p) > CACHED_CHARS]:
                    del second[p]
        return out


def frequent_words(docs: DataFrame, text: str = "text", most: int = TABLE_WORDS) -> list[str]:
    """The words between white space that lead the tasks' summaries: at most ``most``, from all texts."""

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen.update(t.split()) if t else None
                if len(seen) > COUNTERS:
                    low = sorted(seen.values(), reverse=True)[COUNTERS // 2]
                    seen = Counter({w: n - low for w, n in seen.items() if n > low})
        top = [(w, n) for w, n in seen.most_common(TASK_WORDS) if len(w) <= CACHED_CHARS]
        yield pa.RecordBatch.from_pydict(
            {"w": pa.array([w for w, _ in top], pa.string()), "n": pa.array([n for _, n in top], pa.int64())}
        )

    summed = docs.select(F.col(f"`{text}`").alias("t")).mapInArrow(summaries, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
    return [r.w for r in summed.orderBy(F.desc("n"), "w").limit(most).collect()]


_ready: dict[tuple, Counting] = {}  # of this worker


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """key, n_bytes, n_tokens, over_limit of every document. ``path`` is readable on all executors."""
    spark, path = docs.sparkSession, path or tokenizer_path()
    shared = spark.sparkContext.broadcast(frequent_words(docs, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = (path, id(shared.value))
        if at not in _ready:
            _ready.clear()
            _ready[at] = (Counting(path, shared.value), shared.value)  # holds the list, so that its id stays its own
        for batch in batches:
            counts = pa.array(_ready[at][0].counts(batch.column(1).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), counts], ["key", "n_bytes", "n_tokens"])

    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("key"), t.alias("t"), F.octet_length(t).cast("long").alias("n_bytes"))
    kind = docs.schema[key].dataType.simpleString()
    counted = rows.mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
