"""Benchmark decontamination with a generalised suffix automaton of the test items (operator 7).

The automaton's letters are normalised words. It is built from all items and streams the words of
the documents, tracking the longest match that ends at each word. A match of ``window`` words (or a
whole shorter item) marks its words as hit. Words outside the items' vocabulary, and word pairs
that follow each other in no item, end every match, so whole stretches between them are skipped
with numpy before the automaton runs.

Items are packed into shards of at most ``shard_words`` words, one automaton each, and a document is
streamed through all shards. A worker holds the words of the items and at most ``SHARDS_IN_MEMORY``
automata; with more shards than that it builds them again for every batch. Otherwise a batch is
streamed in slices of about ``SLICE_BYTES``, so that few texts are held as words at a time.

Defined results: a null text has no words; an item without words matches nothing; a null item_id
still marks words but is not listed; repeated items count once per id; an empty benchmark leaves all
documents as they are; repeated documents are each judged alone; other columns are carried along.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake.llm.registry import query, table, tidy

WINDOW = 10
SHARD_WORDS = 200_000
SHARDS_IN_MEMORY = 4
SLICE_BYTES = 1 << 20  # of text; as a list of words it takes some ten times as much
MAX_COVERAGE = 0.5
# normalised words: digits, a-z and everything beyond ASCII; A-Z are lower-cased, all else separates
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


class Automaton:
    """Generalised suffix automaton of word sequences, with the windows and items at its states."""

    def __init__(self, items: Sequence[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(i, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for i, words in items if words]
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
        self.shortest = min((min(len(c), window) for _, c in coded), default=window)
        self.at_window: dict[int, set] = {}  # state that holds the window -> item ids
        self.at_whole: dict[int, list[tuple[int, str | None]]] = {}  # state -> (words, id) of short items
        for item, codes in coded:
            state = 0
            for j, c in enumerate(codes):
                state = self.next[state][c]
                if j + 1 >= window:
                    self.at_window.setdefault(self._holding(state, window), set()).add(item)
            if len(codes) < window:
                self.at_whole.setdefault(self._holding(state, len(codes)), []).append((len(codes), item))
        pairs = {a * len(self.vocabulary) + b for _, codes in coded for a, b in zip(codes, codes[1:])}
        self.pairs = np.array(sorted(pairs), dtype=np.int64)

    def _new(self, length: int, link: int, following: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        return len(self.length) - 1

    def _split(self, state: int, code: int, target: int) -> int:
        """The part of ``target`` whose strings continue ``state``'s by one letter, as a state of its own."""
        twin = self._new(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = twin
        while state >= 0 and self.next[state].get(code) == target:
            self.next[state][code] = twin
            state = self.link[state]
        return twin

    def _extend(self, last: int, code: int) -> int:
        known = self.next[last].get(code)
        if known is not None:  # another item has this prefix
            return known if self.length[known] == self.length[last] + 1 else self._split(last, code, known)
        state, new = last, self._new(self.length[last] + 1, 0, {})
        while state >= 0 and code not in self.next[state]:
            self.next[state][code] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][code]
            self.link[new] = target if self.length[target] == self.length[state] + 1 else self._split(state, code, target)
        return new

    def _holding(self, state: int, length: int) -> int:
        """The suffix of ``length`` words of a state's strings belongs to this state."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def codes(self, words: Iterator[bytes], n: int) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, n)

    def stretches(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """Longest [from, to) in which every pair of neighbours follows each other in some item."""
        known = codes >= 0
        if self.shortest == 1:
            joined = known[:-1] & known[1:]
            alone = known
        else:
            spots = np.flatnonzero(known[:-1] & known[1:])
            pair = codes[spots] * len(self.vocabulary) + codes[spots + 1]
            at = np.minimum(np.searchsorted(self.pairs, pair), max(0, len(self.pairs) - 1))
            joined = np.zeros(max(0, len(codes) - 1), dtype=bool)
            if len(self.pairs):
                joined[spots[self.pairs[at] == pair]] = True
            alone = None
        edges = np.flatnonzero(np.diff(np.concatenate([[0], joined.view(np.int8), [0]])))
        for a, b in edges.reshape(-1, 2).tolist():
            if b + 1 - a >= self.shortest:
                yield a, b + 1
        if alone is not None:  # single words count as matches
            covered = np.zeros(len(codes), dtype=bool)
            covered[:-1] |= joined
            covered[1:] |= joined
            for a in np.flatnonzero(alone & ~covered).tolist():
                yield a, a + 1

    def matches(self, codes: np.ndarray) -> Iterator[tuple[int, int, set]]:
        """(from, to, item ids): words [from, to) are a window of these items."""
        window, step, link, length = self.window, self.next, self.link, self.length
        for a, b in self.stretches(codes):
            state = size = 0
            for j, c in enumerate(codes[a:b].tolist(), a + 1):
                while state and c not in step[state]:
                    state = link[state]
                    size = length[state]
                if c in step[state]:
                    state = step[state][c]
                    size += 1
                if size >= window:
                    yield j - window, j, self.at_window[self._holding(state, window)]
                if self.at_whole:
                    up = state
                    while up > 0:
                        for n, item in self.at_whole.get(up, ()):
                            if n <= size:
                                yield j - n, j, {item}
                        up = link[up]


def hits(texts: Sequence[str | None], shards: Iterable[Automaton]) -> Iterator[tuple[int, np.ndarray, set]]:
    """(words, which of them are hit, ids of the items found) for each text."""
    words = [words_of(t) for t in texts]
    sizes = np.array([len(w) + 1 for w in words], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    hit = np.zeros(int(starts[-1]), dtype=bool)
    found: dict[int, set] = {}
    for automaton in shards:
        # the empty word after each text is in no vocabulary: no match goes from one text to the next
        flat = chain.from_iterable(chain(w, (b"",)) for w in words)
        for a, b, items in automaton.matches(automaton.codes(flat, len(hit))):
            hit[a:b] = True
            found.setdefault(int(np.searchsorted(starts, a, side="right")) - 1, set()).update(items)
    for k in range(len(texts)):
        yield int(sizes[k]) - 1, hit[starts[k] : starts[k + 1] - 1], found.get(k, set())


def spans_of(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    return [tuple(x) for x in edges.reshape(-1, 2).tolist()]


def without(text: str, spans: Sequence[tuple[int, int]]) -> str:
    """The text without the words of the spans; a line end marks each gap."""
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw)]
    kept, at = [], 0
    for a, b in spans:
        kept += [raw[at : places[a][0]], b"\n"]
        at = places[b - 1][1]
    return b"".join([*kept, raw[at:]]).decode()


def cleaned(text: str, hit: np.ndarray, shards: Iterable[Automaton], min_span: int) -> str:
    """Spans of ``min_span`` hit words or more go, until what is left holds none."""
    spans = [s for s in spans_of(hit) if s[1] - s[0] >= min_span]
    while spans:
        text = without(text, spans)
        _, hit, _ = next(hits([text], shards))
        spans = [s for s in spans_of(hit) if s[1] - s[0] >= min_span]
    return text


def item_shards(spark: SparkSession, items: DataFrame, item_id: str, text: str, window: int, shard_words: int) -> list:
    """Broadcast lists of (id, words), each of at most about ``shard_words`` words.

    Rows stream to the driver one after the other; an item longer than a shard is cut into pieces that
    overlap by one window less a word, which keeps every window.
    """
    shards: list = []
    part: list = []
    n = 0

    def close() -> None:
        nonlocal part, n
        if part:
            shards.append(spark.sparkContext.broadcast(part))
        part, n = [], 0

    rows = items.select(F.col(f"`{item_id}`").cast("string").alias("i"), F.col(f"`{text}`").alias("t"))
    for row in rows.toLocalIterator():
        words = words_of(row.t)
        for a in range(0, max(1, len(words) - window + 1), shard_words):
            piece = words[a : a + shard_words + window - 1]
            if n and n + len(piece) > shard_words:
                close()
            part.append((row.i, piece))
            n += len(piece)
    close()
    return shards


_built: dict[tuple, tuple] = {}  # of this worker, at most SHARDS_IN_MEMORY


def _automaton(shard, window: int) -> Automaton:
    # workers are reused by later jobs; the entry holds the list, so that its id stays its own
    at = (id(shard.value), len(shard.value), window)
    if at not in _built:
        if len(_built) >= SHARDS_IN_MEMORY:
            _built.pop(next(iter(_built)))
        _built[at] = (Automaton(shard.value, window), shard.value)
    return _built[at][0]


class _Automata:
    """The automata of all shards, one after the other."""

    def __init__(self, shards: list, window: int):
        self.shards, self.window = shards, window

    def __iter__(self) -> Iterator[Automaton]:
        return (_automaton(s, self.window) for s in self.shards)


def slices(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in order, at most ``limit`` bytes of the texts in ``column`` or one row at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = done = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(at, to - at)
        at, done = to, int(ends[to - 1])


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    keep: Sequence[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    clean: bool = False,
    min_span: int = 1,
) -> DataFrame:
    """row (struct of ``keep``), n_words, n_hit, items (sorted ids), spans (of hit words), and the text
    without them if ``clean`` is set."""
    spark = docs.sparkSession
    shards = item_shards(spark, items, item_id, item_text, window, shard_words)
    fields = [T.StructField("row", T.StructType([docs.schema[c] for c in keep]))]
    fields += [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType())]
    fields += [T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType())))]
    fields += [T.StructField("clean", T.StringType())] * clean

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = _Automata(shards, window)
        if len(shards) <= SHARDS_IN_MEMORY:
            batches = chain.from_iterable(slices(b, 1, SLICE_BYTES) for b in batches)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            out: list[list] = [[], [], [], [], []]
            for t, (n, hit, found) in zip(texts, hits(texts, automata)):
                any_hit = bool(hit.any())
                out[0].append(n)
                out[1].append(int(hit.sum()))
                out[2].append(sorted(i for i in found if i is not None))
                out[3].append([list(s) for s in spans_of(hit)] if any_hit else [])
                if clean:
                    out[4].append(cleaned(t, hit, automata, min_span) if any_hit else t)
            columns = [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())]
            columns += [pa.array(out[2], pa.list_(pa.string())), pa.array(out[3], pa.list_(pa.list_(pa.int32())))]
            columns += [pa.array(out[4], pa.string())] * clean
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("t"))
    return rows.mapInArrow(tidy(run), T.StructType(fields))


def decontaminated(docs: DataFrame, items: DataFrame, max_coverage: float = MAX_COVERAGE, text: str = "text") -> DataFrame:
    """The columns of ``docs``: leaked spans are cut out; documents with more than ``max_coverage`` of
    their words in leaked spans go."""
    others = [c for c in docs.columns if c != text] or docs.columns  # the text travels once
    found = find_leaks(docs, items, others, text=text, clean=True)
    kept = found.filter(F.col("n_hit") <= max_coverage * F.col("n_words"))
    return kept.select(*[(F.col("clean") if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns])


OP7_SQL = r"""
WITH lw AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u, 'abcdefghijklmnopqrstuvwxyz' AS l),
d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents, lw),
b AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(text, u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark, lw),
bw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes)),
m AS (SELECT DISTINCT doc_id, item_id, i, dw.n AS n FROM dw JOIN bw ON dw.n = bw.n AND dw.w = bw.w),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
g AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS s
      FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN g ON d.doc_id = g.doc_id
"""


@query("op7_decontaminate", OP7_SQL)
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "row.doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
