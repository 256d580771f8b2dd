"""Exact substring deduplication by a sparse suffix array with bucket-pointer refinement (operator 12).

A byte goes if it is covered by a window of ``SPAN`` bytes that also starts earlier (smaller id, or same
text, earlier start). What counts as earlier is judged on the input.

1. Initial q-gram buckets. Every window picks one of its grams (suffixes.py); neighbouring windows with
   the same pick are one segment, so a text has one row per some 40 bytes, not per byte. Segments are
   dealt by gram, equal segments of an Arrow batch as one row. Within the sorted stream of a task all
   but the first of equal segments are repeats; a bucket with one kind of segment is finished.
2. Refinement. Of buckets with several kinds, the first segment of each kind is read again from its text.
   Whole buckets are pooled up to ``POOL_BYTES``; all suffixes of a pool are sorted by bucket pointers at
   later offsets until windows are told apart, and all but the earliest of equal windows are repeats.
3. The repeated windows of a text are gathered on its row, joined to the text and cut out.

Grams that a bounded sample of texts (``SAMPLE_TEXTS``) shows to be very frequent are only picked by
windows that have no other. This moves rows away from hot buckets; results do not depend on it.
Buckets with more than ``BIG`` kinds are not pooled; each of their windows becomes a segment of its own
and takes step 1 again. No step gathers a bucket, and no text is cut short.

Order is by id, nulls last, then a hash of the text. Defined results: a null text is empty; texts under ``SPAN``
bytes keep all; of repeated rows (same id and text) one is the earlier; other columns are not
handed on; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.registry import query, table
from caselake.llm.suffixes import equal_windows, segments
from caselake.operators.joins import lookup_join
from caselake.session import materialise

SPAN, GRAM = 100, 24
POOL_BYTES = 2 << 20
BIG = 10_000  # segments of one bucket
SAMPLE_TEXTS = 20_000
SAMPLE_SHARE = 0.01
FREQUENT_SHARE = 0.002  # of the sampled texts
MOST_FREQUENT = 100_000  # grams that are avoided
NO_ID = (1 << 63) - 1
_OTHER = np.dtype([("id", "<i8"), ("tie", "<i8"), ("start", "<i4")])
_SEGMENT = {"anchor": pa.int64(), "content": pa.int64(), "id": pa.int64(), "tie": pa.int64(), "start": pa.int32(), "windows": pa.int32(), "others": pa.binary()}
_FOUND = {"kind": pa.string(), "anchor": pa.int64(), "id": pa.int64(), "tie": pa.int64(), "start": pa.int32(), "windows": pa.int32()}
_DDL = {pa.int64(): "bigint", pa.int32(): "int", pa.binary(): "binary", pa.string(): "string"}


def _ddl(fields: dict) -> str:
    return ", ".join(f"{name} {_DDL[kind]}" for name, kind in fields.items())


def _rows(fields: dict, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[name], kind) for name, kind in fields.items()], list(fields))


def _earliest(s: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Segments of one batch, in order -> one row per kind, with the places of its copies packed."""
    order = np.lexsort((s["content"], s["anchor"]))  # stable: the earliest of each kind stays first
    s = {c: v[order] for c, v in s.items()}
    new = np.ones(len(order), dtype=bool)
    new[1:] = (s["anchor"][1:] != s["anchor"][:-1]) | (s["content"][1:] != s["content"][:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(new)))
    packed = np.zeros(len(new), dtype=_OTHER)
    for c in ("id", "tie", "start"):
        packed[c] = s[c]
    ends = np.cumsum((count - 1) * _OTHER.itemsize)
    others = pa.Array.from_buffers(
        pa.binary(), len(first), [None, pa.py_buffer(np.append(0, ends).astype(np.int32).tobytes()), pa.py_buffer(packed[~new].tobytes())]
    )
    yield _rows(_SEGMENT, {**{c: v[first] for c, v in s.items()}, "others": others})


def _cut(frequent: np.ndarray, span: int, gram: int):
    """Texts (id, tie, text) -> rows of segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            texts = batch.column(2).to_pylist()
            order = np.lexsort((ties, ids))
            keep = np.ones(len(order), dtype=bool)  # repeated rows are one text here
            keep[1:] = (ids[order][1:] != ids[order][:-1]) | (ties[order][1:] != ties[order][:-1])
            order = order[keep]
            raw = [texts[k].encode() for k in order.tolist()]
            found, size = [], 0
            for part in segments(raw, span, gram, frequent):
                found.append(part)
                size += len(part.start)
                if size > 200_000:
                    yield from _earliest(_joined(found, ids[order], ties[order]))
                    found, size = [], 0
            if found:
                yield from _earliest(_joined(found, ids[order], ties[order]))

    return run


def _joined(found: list, ids: np.ndarray, ties: np.ndarray) -> dict[str, np.ndarray]:
    text, start, windows, anchor, content = (np.concatenate(c) for c in zip(*found))
    return {
        "anchor": anchor.view(np.int64), "content": content.view(np.int64), "id": ids[text], "tie": ties[text],
        "start": start.astype(np.int32), "windows": windows.astype(np.int32),
    }


def _repeats(settled: bool):
    """Rows sorted by (anchor, content, id, tie, start) -> repeated segments ("gone") and, unless buckets
    are ``settled``, the first segment of each kind in buckets of several kinds ("open")."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # last row: (anchor, content, id, tie, start)
        pending: list[np.ndarray] = []  # the only kind so far of the last bucket
        several = None  # the last bucket, once it has several kinds
        names = ["anchor", "content", "id", "tie", "start"]
        for batch in batches:
            if not batch.num_rows:
                continue
            c = {n: batch.column(n).to_numpy() for n in [*names, "windows"]}
            same_kind = np.zeros(batch.num_rows, dtype=bool)
            same_row = np.zeros(batch.num_rows, dtype=bool)
            same_kind[1:] = (c["anchor"][1:] == c["anchor"][:-1]) & (c["content"][1:] == c["content"][:-1])
            same_row[1:] = same_kind[1:] & (c["id"][1:] == c["id"][:-1]) & (c["tie"][1:] == c["tie"][:-1]) & (c["start"][1:] == c["start"][:-1])
            if before is not None:
                now = tuple(int(c[n][0]) for n in names)
                same_kind[0], same_row[0] = now[:2] == before[:2], now == before
            before = tuple(int(c[n][-1]) for n in names)
            gone = same_kind & ~same_row
            held = batch.column("others")
            sizes = np.diff(np.frombuffer(held.buffers()[1], dtype=np.int32)[held.offset : held.offset + len(held) + 1]) // _OTHER.itemsize
            packed = np.frombuffer(b"".join(held.to_pylist()), dtype=_OTHER) if sizes.any() else np.zeros(0, dtype=_OTHER)
            out = {n: np.concatenate([c[n][gone], packed[n]]) for n in ("id", "tie", "start")}
            out["windows"] = np.concatenate([c["windows"][gone], np.repeat(c["windows"], sizes)])
            if len(out["id"]):
                yield _found("gone", np.repeat(np.int64(0), len(out["id"])), out)
            if settled:
                continue
            kinds = np.flatnonzero(~same_kind)
            if not len(kinds):
                continue
            rows = np.stack([c[n][kinds].astype(np.int64) for n in ("anchor", "id", "tie", "start", "windows")], axis=1)
            rows = np.concatenate([*pending, rows]) if pending else rows
            pending = []
            bucket = rows[:, 0]
            edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            count = np.diff(np.append(edge, len(bucket)))
            open_ = np.repeat((count > 1) | (bucket[edge] == several if several is not None else np.zeros(len(edge), dtype=bool)), count)
            if open_[-1]:
                several = int(bucket[-1])
            else:  # its bucket may go on in the next batch
                several, pending, open_[-1:] = None, [rows[-1:]], False
            rows = rows[open_]
            if len(rows):
                yield _found("open", rows[:, 0], dict(zip(("id", "tie", "start", "windows"), rows[:, 1:].T)))

    return run


def _found(kind: str, anchor: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return _rows(_FOUND, {"kind": [kind] * len(anchor), "anchor": anchor, **columns})


def _read(span: int, alone: bool):
    """Texts with the places of their open segments -> the segments' bytes; or, of buckets too big to be
    pooled (``alone``), one segment per window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = row["text"].encode()
                if alone:
                    for p in row["places"]:
                        cut = raw[p["start"] : p["start"] + p["windows"] + span - 1]
                        one = [cut[k : k + span] for k in range(p["windows"])]
                        parts = list(segments(one, span, span, np.zeros(0, np.uint64)))
                        s = _joined(parts, np.full(len(one), row["id"]), np.full(len(one), row["tie"]))
                        s["start"] = s["start"] + np.arange(len(one), dtype=np.int32) + np.int32(p["start"])
                        yield from _earliest(s)
                else:
                    cuts = [raw[p["start"] : p["start"] + p["windows"] + span - 1] for p in row["places"]]
                    columns = {c: [p[c] for p in row["places"]] for c in ("anchor", "start", "windows")}
                    yield _rows(_OPEN, {**columns, "id": [row["id"]] * len(cuts), "tie": [row["tie"]] * len(cuts), "bytes": cuts})

    return run


_OPEN = {"anchor": pa.int64(), "id": pa.int64(), "tie": pa.int64(), "start": pa.int32(), "windows": pa.int32(), "bytes": pa.binary()}


def _pools(span: int, pool_bytes: int):
    """Open segments, sorted by bucket -> repeated windows. Pools end between buckets."""

    def refined(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        rows = sorted(rows, key=lambda r: (r["id"], r["tie"], r["start"]))
        data = np.frombuffer(b"".join(r["bytes"] for r in rows), dtype=np.uint8)
        size = np.array([len(r["bytes"]) for r in rows])
        windows = np.array([r["windows"] for r in rows])
        base = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(rows)), windows)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        pointer = equal_windows(data, base[owner] + within, span)
        order = np.argsort(pointer, kind="stable")  # rows are in order, so the earliest comes first
        gone = np.zeros(len(order), dtype=bool)
        gone[order[1:]] = pointer[order[1:]] == pointer[order[:-1]]
        places = np.flatnonzero(gone)
        if not len(places):
            return
        new = np.ones(len(places), dtype=bool)
        new[1:] = (places[1:] != places[:-1] + 1) | (owner[places[1:]] != owner[places[:-1]])
        first = np.flatnonzero(new)
        who = owner[places[first]]
        value = lambda c: np.array([r[c] for r in rows])[who]
        yield _found(
            "gone", np.zeros(len(first), dtype=np.int64),
            {"id": value("id"), "tie": value("tie"), "start": value("start") + within[places[first]], "windows": np.diff(np.append(first, len(places)))},
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool: list[dict] = []
        size, bucket = 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if size >= pool_bytes and row["anchor"] != bucket:
                    yield from refined(pool)
                    pool, size = [], 0
                pool.append(row)
                size += len(row["bytes"])
                bucket = row["anchor"]
        if pool:
            yield from refined(pool)

    return run


def _collapsed(span: int):
    """(doc_id, text, copies, starts, windows) -> what is left of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, text, copies, gone in zip(*(batch.column(k).to_pylist() for k in range(4))):
                raw, cut, spans, kept, at = (text or "").encode(), 0, 0, [], 0
                for s, w in sorted((g["start"], g["windows"]) for g in gone or []):
                    stop = s + w + span - 1
                    if spans and s <= at:  # touches the stretch before
                        cut += max(0, stop - at)
                        at = max(at, stop)
                        continue
                    kept.append(raw[at:s])
                    cut, spans, at = cut + stop - s, spans + 1, stop
                kept.append(raw[at:])
                out.append((doc, len(raw), cut, spans, b"".join(kept)))
                for _ in range(1, copies or 1):
                    out.append((doc, len(raw), len(raw), 1, b"") if len(raw) >= span else (doc, len(raw), 0, 0, raw))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def _frequent(texts: DataFrame, span: int, gram: int) -> np.ndarray:
    """Hashes of grams picked in many texts of a sample: at most ``MOST_FREQUENT``, most frequent first."""
    total = texts.count()
    sample = texts.sample(min(1.0, max(SAMPLE_SHARE, 200 / max(total, 1)), SAMPLE_TEXTS / max(total, 1)), seed=12)
    picks = sample.mapInArrow(_cut(np.zeros(0, np.uint64), span, gram), _ddl(_SEGMENT)).select("anchor", "id", "tie").distinct()
    least = max(20, FREQUENT_SHARE * min(SAMPLE_TEXTS, SAMPLE_SHARE * total))
    often = picks.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    found = often.orderBy(F.desc("n"), "anchor").limit(MOST_FREQUENT).select("anchor").toPandas()["anchor"]
    return np.sort(found.to_numpy(dtype=np.int64).view(np.uint64))


def _settle(rows: DataFrame, settled: bool, name: str) -> DataFrame:
    order = ["anchor", "content", "id", "tie", "start"]
    stream = rows.repartition("anchor", "content") if settled else rows.repartition("anchor")
    return materialise(stream.sortWithinPartitions(*order).mapInArrow(_repeats(settled), _ddl(_FOUND)), name, ("kind",))


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, gram: int = GRAM, big: int = BIG, pool_bytes: int = POOL_BYTES
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes): one row per row of ``docs``."""
    given = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    given = given.withColumns({"id": F.coalesce("doc_id", F.lit(NO_ID)), "tie": F.xxhash64("text", F.col("doc_id").isNull())})
    # rows that repeat id and text are one text with copies
    repeated = given.groupBy("id", "tie").agg(F.count("*").alias("copies")).filter("copies > 1")
    repeated = materialise(repeated, "suffix_repeated_rows")
    single = given.withColumn("copies", F.lit(1).cast("long"))
    if repeated.limit(1).count():
        rest = given.join(repeated.select("id", "tie"), ["id", "tie"], "left_anti").withColumn("copies", F.lit(1).cast("long"))
        single = rest.unionByName(given.dropDuplicates(["id", "tie"]).join(repeated, ["id", "tie"]))
    long = given.filter(F.octet_length("text") >= span).select("id", "tie", "text")
    cut = long.mapInArrow(_cut(_frequent(long, span, gram), span, gram), _ddl(_SEGMENT))
    found = _settle(cut, False, "suffix_buckets")
    opened = found.filter("kind = 'open'")
    sizes = opened.groupBy("anchor").agg(F.count("*").alias("kinds")).filter(F.col("kinds") > big)
    large = materialise(sizes.select("anchor", F.lit(True).alias("large")), "suffix_large")
    marked = lookup_join(opened, large, ["anchor"])
    gone = [found.filter("kind = 'gone'")]
    ways = [(False, "large is null")] + ([(True, "large")] if large.limit(1).count() else [])
    for alone, which in ways:
        place = F.struct("anchor", "start", "windows")
        places = marked.filter(which).groupBy("id", "tie").agg(F.collect_list(place).alias("places"))
        read = places.join(single.select("id", "tie", "text"), ["id", "tie"]).mapInArrow(_read(span, alone), _ddl(_SEGMENT if alone else _OPEN))
        if alone:
            gone.append(_settle(read, True, "suffix_windows").filter("kind = 'gone'"))
        else:
            stream = read.repartition("anchor").sortWithinPartitions("anchor")
            gone.append(materialise(stream.mapInArrow(_pools(span, pool_bytes), _ddl(_FOUND)), "suffix_pools"))
    spans = gone[0].select("id", "tie", "start", "windows")
    for more in gone[1:]:
        spans = spans.unionByName(more.select("id", "tie", "start", "windows"))
    spans = spans.groupBy("id", "tie").agg(F.collect_list(F.struct("start", "windows")).alias("gone"))
    joined = single.join(spans, ["id", "tie"], "left").select("doc_id", "text", "copies", "gone")
    return joined.mapInArrow(_collapsed(span), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


OP12_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, p, md5(substring(h, 2 * p + 1, 200)) AS k FROM d, unnest(range(n - 99)) u(p) WHERE n >= 100),
g AS (SELECT doc_id, p FROM w QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1),
s AS (SELECT *, CASE WHEN p <= lag(p) OVER v + 100 THEN 0 ELSE 1 END AS new FROM g WINDOW v AS (PARTITION BY doc_id ORDER BY p)),
i AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM s),
r AS (SELECT doc_id, run, min(p) AS a, max(p) + 100 AS b FROM i GROUP BY doc_id, run),
c AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM r),
k AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
             string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
      FROM c JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substring(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@query("op12_suffix_dedup", OP12_SQL)
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
