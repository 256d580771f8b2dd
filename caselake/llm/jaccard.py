"""N-gram Jaccard join with several global token orders (operator 4).

Documents are sets of distinct word shingles; two link when their Jaccard similarity is at least
``percent`` / 100. If they link, their prefixes (the first n - ceil(n * percent / 100) + 1 shingles
in any one global order) share a shingle, whatever the order is. Candidates must pass that filter
under two orders, both with the counts that a link needs, before the sets are compared.

1. One row per document: size and a 64-bit name of its set, its class. Copies share a class; from
   here on only classes take part.
2. Shingles of many documents are counted exactly (in ranges of their hashes, packed on the map
   side) and go to the end of both orders by frequency, so that a passage of many documents leaves
   the prefixes. At most ``FREQUENT`` of them are told to the tasks. That bounds the broadcast and
   decides the order only: any order gives the same links.
3. Prefixes under the first order are dealt by shingle, sorted, and cut to shingles of two classes.
4. Star rounds: each shingle names its first class as leader, each class compares itself with the
   leader it meets most often. Links found here join large groups with few comparisons.
5. All pairs of classes that share a prefix shingle and are not yet in one component are compared,
   after length and position filters and the filter under the second order.

Pairs within a component need no comparison: the result is the class of each document, and a link
can only join what is already joined. No link between components is left out.

Defined results: a null text or one without words is an empty set (n_shingles 0), linked with
nothing; repeated rows and equal texts are one component; null ids never name a component while it
has other ids; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.components import connected_components
from caselake.llm.registry import query, table, tidy
from caselake.llm.shingles import mix, shingle_sets
from caselake.session import materialise

WORDS = 5
PERCENT = 75
OFTEN = 4  # documents of a shingle beyond which its frequency decides its place
FREQUENT = 1_000_000  # shingles told to the tasks, the most frequent ones
RANGE_SHINGLES = 4_000_000  # counted by one task
STAR_ROUNDS = 2
BROADCAST_ROWS = 1_000_000
_SECOND = np.uint64(0x5851F42D4C957F2D)


def need(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Shared shingles that sets of these sizes need to link."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


class Frequent(NamedTuple):
    """Frequent shingles (their upper 40 bits, sorted) and the class of their frequency."""

    shingle: np.ndarray
    group: np.ndarray


def ordered(s: np.ndarray, frequent: Frequent, second: bool, size: int) -> np.ndarray:
    """The first ``size`` of a sorted set under the first or the second order."""
    group = np.zeros(len(s), dtype=np.uint8)
    if len(frequent.shingle):
        upper = s >> np.uint64(24)
        at = np.minimum(np.searchsorted(frequent.shingle, upper), len(frequent.shingle) - 1)
        group = np.where(frequent.shingle[at] == upper, frequent.group[at], 0)
    if second:
        return s[np.lexsort((mix(s ^ _SECOND), group))[:size]]
    return s[:size] if not group[:size].any() else s[np.argsort(group, kind="stable")[:size]]


def class_of(s: np.ndarray) -> int:
    """64-bit name of a set; empty sets have none."""
    places = np.arange(1, len(s) + 1, dtype=np.uint64)
    return int(mix(mix(s ^ mix(places)).sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0])


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    t = F.col(f"`{text}`")
    return docs.select(F.col(f"`{key}`").alias("doc_id"), F.xxhash64(t).alias("th"), t.alias("t"))


def document_classes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, th (hash of the text), n, cls of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [(len(s), class_of(s) if len(s) else None) for s in shingle_sets(b.column(2).to_pylist(), WORDS)]
            n, cls = pa.array([x[0] for x in sets], pa.int64()), pa.array([x[1] for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), n, cls], ["doc_id", "th", "n", "cls"])

    kind = docs.schema[key].dataType.simpleString()
    return _texts(docs, key, text).mapInArrow(tidy(run), f"doc_id {kind}, th long, n long, cls long")


def frequent_shingles(docs: DataFrame, shingles: int, text: str, often: int = OFTEN, most: int = FREQUENT) -> Frequent:
    """Shingles with more than ``often`` documents, the most frequent ``most`` of them."""
    ranges = max(64, -(-shingles // RANGE_SHINGLES))
    width = -(-(1 << 40) // ranges)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            s, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            part = s // np.uint64(width)
            at = np.flatnonzero(np.diff(part, prepend=np.uint64(2**63)))
            edges = [*at.tolist(), len(s)]
            # five bytes a shingle, byte by byte: the upper bytes of sorted numbers compress away
            planes = [b"".join(s[a:b].view(np.uint8).reshape(-1, 8)[:, k].tobytes() for k in range(5)) for a, b in zip(edges, edges[1:])]
            counts = [np.minimum(n[a:b], 65535).astype(np.uint16).tobytes() for a, b in zip(edges, edges[1:])]
            return pa.RecordBatch.from_arrays(
                [pa.array(part[at].astype(np.int64)), pa.array(planes, pa.binary()), pa.array(counts, pa.binary())], ["part", "s", "n"]
            )

        size = 0
        for b in batches:
            for s in shingle_sets(b.column(0).to_pylist(), WORDS):
                upper = s >> np.uint64(24)
                held.append(upper[np.diff(upper, prepend=np.uint64(2**63)) != 0])
                size += len(upper)
                if size > RANGE_SHINGLES // 2:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    def counted(rows: pa.Table) -> pa.Table:
        def unpack(raw: bytes) -> np.ndarray:
            planes = np.frombuffer(raw, np.uint8).reshape(5, -1)
            out = np.zeros((planes.shape[1], 8), np.uint8)
            out[:, :5] = planes.T
            return out.reshape(-1).view(np.uint64)

        s = np.concatenate([unpack(x.as_py()) for x in rows["s"]])
        n = np.concatenate([np.frombuffer(x.as_py(), np.uint16) for x in rows["n"]]).astype(np.int64)
        order = np.argsort(s)
        s, n = s[order], n[order]
        at = np.flatnonzero(np.diff(s, prepend=np.uint64(2**63)))
        total = np.add.reduceat(n, at)
        many = total > often
        return pa.table({"s": s[at][many].astype(np.int64), "g": np.log2(total[many]).astype(np.int32)})

    blobs = docs.select(F.col(f"`{text}`").alias("t")).mapInArrow(tidy(packed), "part long, s binary, n binary")
    found = materialise(blobs.groupBy("part").applyInArrow(counted, "s long, g int"), "frequent")
    sizes = sorted(((r["g"], r["count"]) for r in found.groupBy("g").count().collect()), reverse=True)
    least, total = 64, 0
    for g, n in sizes:
        if total + n > most:
            break
        least, total = g, total + n
    got = found.filter(F.col("g") >= least).toArrow().sort_by("s")
    return Frequent(got["s"].to_numpy().astype(np.uint64), got["g"].to_numpy().astype(np.uint8))


def prefix_rows(docs: DataFrame, frequent, text: str, percent: int) -> DataFrame:
    """token, cls, n, pos of the shingles in first-order prefixes that two classes or more have there."""
    names = ["token", "cls", "n", "pos"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # classes of this task so far; only saves work
        for b in batches:
            parts, cls, size = [], [], []
            for s in shingle_sets(b.column(0).to_pylist(), WORDS):
                name = class_of(s)
                if not len(s) or name in seen:
                    continue
                if len(seen) < 500_000:
                    seen.add(name)
                parts.append(ordered(s, frequent.value, False, prefix_size(len(s), percent)))
                cls.append(name)
                size.append(len(s))
            if parts:
                k = [len(p) for p in parts]
                pos = np.arange(sum(k), dtype=np.int32) - np.repeat(np.cumsum(k) - k, k).astype(np.int32)
                columns = [np.concatenate(parts).view(np.int64), np.repeat(np.array(cls, np.int64), k), np.repeat(np.array(size, np.int32), k), pos]
                for a in range(0, len(pos), 200_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[a : a + 200_000]) for c in columns], names)

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by (token, cls); a row stays if its token has another class
        before: tuple[int, int] | None = None  # token and class of the last distinct row
        waiting: list | None = None  # that row, while its token has one class
        for b in batches:
            c = [b.column(k).to_numpy() for k in range(4)]
            fresh = np.ones(len(c[0]), dtype=bool)
            fresh[1:] = (c[0][1:] != c[0][:-1]) | (c[1][1:] != c[1][:-1])
            fresh[0] = before is None or before != (int(c[0][0]), int(c[1][0]))
            c = [x[fresh] for x in c]
            if not len(c[0]):
                continue
            same = c[0][1:] == c[0][:-1]
            keep = np.zeros(len(c[0]), dtype=bool)
            keep[1:] |= same
            keep[:-1] |= same
            if before is not None and before[0] == c[0][0]:
                keep[0] = True
                if waiting is not None:
                    c, keep = [np.concatenate([[w], x]).astype(x.dtype) for w, x in zip(waiting, c)], np.concatenate([[True], keep])
            before = (int(c[0][-1]), int(c[1][-1]))
            waiting = None if keep[-1] else [x[-1] for x in c]
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in c], names)

    kinds = "token long, cls long, n int, pos int"
    rows = docs.select(F.col(f"`{text}`").alias("t")).mapInArrow(tidy(emit), kinds)
    dealt = rows.repartition(F.col("token")).sortWithinPartitions("token", "cls")
    return dealt.mapInArrow(tidy(shared), kinds)


def limited_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its rows (a few numbers each) are few enough."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


class Sets:
    """The sets of some classes, read from one document of each."""

    def __init__(self, docs: DataFrame, classes: DataFrame, frequent, key: str, text: str, percent: int):
        self.docs, self.classes, self.frequent, self.percent = _texts(docs, key, text), classes, frequent, percent

    def of(self, wanted: DataFrame, sketches: bool) -> DataFrame:
        """cls, n, s (eight bytes a shingle), and with ``sketches`` p1, p2: the lower halves of both prefixes."""
        percent, frequent = self.percent, self.frequent
        first = self.classes.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.min(F.struct("doc_id", "th")).alias("d"))
        first = materialise(first.select(F.col("d.doc_id").alias("i"), F.col("d.th").alias("h")), "readers")
        here = (F.col("doc_id").eqNullSafe(F.col("i"))) & (F.col("th") == F.col("h"))
        texts = self.docs.join(limited_broadcast(first), here, "left_semi").select("t")
        names = ["cls", "n", "s", *(["p1", "p2"] * sketches)]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for b in batches:
                rows: list[list] = [[] for _ in names]
                for s in shingle_sets(b.column(0).to_pylist(), WORDS):
                    name = class_of(s)
                    if not len(s) or name in seen:
                        continue
                    if len(seen) < 500_000:
                        seen.add(name)
                    row = [name, len(s), s.tobytes()]
                    if sketches:
                        size = prefix_size(len(s), percent)
                        row += [np.unique(ordered(s, frequent.value, k, size).astype(np.uint32)).tobytes() for k in (False, True)]
                    for column, x in zip(rows, row):
                        column.append(x)
                kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds)], names)

        return materialise(texts.mapInArrow(tidy(run), "cls long, n int, s binary" + ", p1 binary, p2 binary" * sketches), "sets")


def _beside(pairs: DataFrame, sets: DataFrame, columns: list[str]) -> DataFrame:
    """pairs (a, b) with the columns of both classes, as x_a and x_b."""
    for side in ("b", "a"):
        pairs = pairs.join(sets.select(F.col("cls").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
    return pairs


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _beside(pairs, sets, ["s"]).select("a", "b", "s_a", "s_b").mapInArrow(tidy(run), "a long, b long")


def _may_link(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that share as many prefix shingles as a link needs, under the first and the second order."""
    columns = ["n", "p1", "p2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for r in batch.to_pylist():
                n = [r["n_a"], r["n_b"]]
                # shared shingles outside of both prefixes lie beyond the prefix that ends first in the order
                beyond = max(k - prefix_size(k, percent) for k in n)
                least = max(1, int(need(n[0], n[1], percent)) - beyond)
                common = (len(np.intersect1d(*[np.frombuffer(r[f"p{k}_{side}"], np.uint32) for side in "ab"], assume_unique=True)) for k in (1, 2))
                keep.append(all(c >= least for c in common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _beside(pairs, sets, columns).mapInArrow(tidy(run), "a long, b long")


def _may_fit(percent: int) -> Column:
    """Length filter for columns n_a <= n_b."""
    return F.col("n_a") * 100 >= F.col("n_b") * percent


def _labelled(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Prefix rows with the component of their class, of shingles that still join different components."""
    if roots is None:
        return rows.withColumn("root", F.col("cls"))
    named = rows.join(roots.select(F.col("node").alias("cls"), F.col("root")), "cls", "left")
    named = named.select("token", "cls", "n", "pos", F.coalesce("root", "cls").alias("root"))
    split = named.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("token")
    return materialise(named.join(split, "token", "left_semi"), "prefixes")


def _stars(rows: DataFrame, percent: int, turn: int) -> DataFrame:
    """For each class the leader that it meets most often among those of fitting length.

    In even turns a shingle's leader is the class whose prefix is shared most, for its size: among near
    copies that is the text they were made from. Odd turns draw the leaders, for what that missed.
    """
    if turn % 2 == 0:
        shared = rows.groupBy("token").agg(F.count("*").alias("others"))
        rank = rows.join(shared, "token").groupBy("cls").agg((F.sum("others") / F.max("n")).alias("rank"))
        ranked = rows.join(rank, "cls")
    else:
        ranked = rows.withColumn("rank", F.xxhash64("root", F.lit(turn)).cast("double"))
    leader = ranked.groupBy("token").agg(F.max(F.struct("rank", "cls", "n", "root")).alias("l"))
    met = rows.join(leader, "token").filter("root <> l.root")
    fits = F.least("n", "l.n") * 100 >= F.greatest("n", "l.n") * percent
    counted = met.filter(fits).groupBy("cls", "n", F.col("l.cls").alias("b")).count()
    # a link shares about a seventh of the smaller set in the prefixes; fewer is left to the full comparison
    best = counted.filter("10 * count >= n").groupBy("cls").agg(F.max(F.struct("count", "b")).alias("m"))
    return best.select(F.least("cls", "m.b").alias("a"), F.greatest("cls", "m.b").alias("b")).distinct()


def _crossing(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share a prefix shingle where a link would have to start."""
    side = lambda x: rows.select("token", *[F.col(c).alias(f"{c}_{x}") for c in ("cls", "n", "pos", "root")])
    order = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("cls_a") < F.col("cls_b")))
    left = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) * (100 + percent)
    reaches = left >= (F.col("n_a") + F.col("n_b")) * percent
    pairs = side("a").join(side("b"), "token").filter((F.col("root_a") != F.col("root_b")) & order & _may_fit(percent) & reaches)
    return pairs.select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, th, n_shingles, cls, component_id: one row per document."""
    spark = docs.sparkSession
    rows = materialise(document_classes(docs, key, text), "classes")
    classes = rows.filter(F.col("n") > 0)
    total = classes.agg(F.sum("n")).first()[0] or 0
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs, total, text))
    prefixes = materialise(prefix_rows(docs, frequent, text, percent), "prefixes")
    sets = Sets(docs, classes, frequent, key, text, percent)

    links: list[DataFrame] = []
    roots = None
    ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    for turn in range(STAR_ROUNDS):
        stars = materialise(_stars(_labelled(prefixes, roots), percent, turn), "stars")
        links.append(materialise(_linked(stars, sets.of(ends(stars), False), percent), "links"))
        roots = connected_components(_union(links))
    crossing = materialise(_crossing(_labelled(prefixes, roots), percent), "pairs")
    held = sets.of(ends(crossing), True)
    filtered = materialise(_may_link(crossing, held, percent), "pairs")
    links.append(materialise(_linked(filtered, held, percent), "links"))
    roots = connected_components(_union(links))

    ids = classes.groupBy("cls").agg(F.min("doc_id").alias("least"))
    named = ids.join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = materialise(named.join(least, "root").select("cls", "component_id"), "components")
    joined = rows.join(of_class, "cls", "left")
    return joined.select("doc_id", "th", F.col("n").alias("n_shingles"), "cls", F.coalesce("component_id", "doc_id").alias("component_id"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``docs``: of each component the document with the smallest id stays, of rows that
    repeat it one. Documents without words and without id stay."""
    found = near_duplicates(docs, key, text)
    same = found.groupBy("doc_id", "th").agg(F.count("*").alias("rows"), F.min("component_id").alias("c"), F.max("n_shingles").alias("n"))
    same = materialise(same.filter("doc_id is not null and n > 0").withColumn("gone", F.col("c") != F.col("doc_id")), "decisions")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    wrapped = docs.select(whole, F.col(f"`{key}`").alias("i"), F.xxhash64(F.col(f"`{text}`")).alias("h"))
    named = lambda rows: limited_broadcast(rows.select(F.col("doc_id").alias("i"), F.col("th").alias("h")))
    kept = wrapped.join(named(same.filter("gone or rows > 1")), ["i", "h"], "left_anti")
    again = same.filter("rows > 1 and not gone")
    if again.limit(1).count():
        kept = kept.unionByName(wrapped.join(named(again), ["i", "h"], "left_semi").dropDuplicates(["i", "h"]))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


@query("op4_jaccard_join")
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")
