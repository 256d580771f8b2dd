"""Suffix-array deduplication against brute force on small windows, with every way of settling a bucket."""

import hashlib
import random

import numpy as np
import pytest

from caselake.llm import suffix_dedup, suffixes


def by_brute_force(rows, span):
    """rows: (doc_id, text). Ids None last; rows equal in id take the order of ``rows`` here."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    seen, out = set(), []
    for k in order:
        raw = (rows[k][1] or "").encode()
        cut = set()
        for p in range(len(raw) - span + 1):
            w = raw[p : p + span]
            if w in seen:
                cut.update(range(p, p + span))
            seen.add(w)
        spans = sum(1 for p in cut if p - 1 not in cut)
        out.append((rows[k][0], len(raw), len(cut), spans, bytes(b for p, b in enumerate(raw) if p not in cut)))
    return sorted(out, key=repr)


def texts(seed):
    rng = random.Random(seed)
    pool, rows = ["".join(rng.choice("ab é") for _ in range(60))], []
    for k in rng.sample(range(1000), 150):
        kind, t = rng.random(), ""
        if kind < 0.2:
            t = rng.choice(pool)  # copies
        elif kind < 0.5:
            a = rng.choice(pool)
            t = "".join(rng.choice("xyz") for _ in range(rng.randrange(9))) + a[rng.randrange(9) :] + rng.choice("pq")
        elif kind < 0.6:
            t = rng.choice("ab") * rng.randrange(120)
        elif kind < 0.95:
            t = "".join(rng.choice("abc") for _ in range(rng.randrange(150))) + "one line of all " * rng.randrange(3)
        pool.append(t)
        rows.append((k, t))
    return rows


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"big": 3}), (3, {"big": 0, "pool_bytes": 100}), (4, {"pool_bytes": 1})])
def test_against_brute_force(spark, seed, options):
    rows = texts(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = suffix_dedup.without_repeats(docs, span=16, gram=6, **options).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=repr) == by_brute_force(rows, 16)


def test_odd_rows(spark, odd):
    got = suffix_dedup.without_repeats(odd, span=16, gram=6).collect()
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert len(got) == len(rows)
    want = by_brute_force(rows, 16)
    key = lambda r: (r[0], r[1])  # noqa: E731  rows with equal ids and equal texts
    assert sorted(map(repr, map(key, ((r.doc_id, r.n_bytes) for r in got)))) == sorted(repr(key(w)) for w in want)
    assert sum(r.n_removed for r in got) == sum(w[2] for w in want)
    assert suffix_dedup.without_repeats(odd.limit(0)).collect() == []


def test_frequent_grams_only_move_rows():
    rng = random.Random(8)
    raw = [("".join(rng.choice("ab") for _ in range(90)) + " a line of all ").encode() * 2 for _ in range(30)]
    none = np.zeros(0, np.uint64)
    plain = [np.concatenate(c) for c in zip(*suffixes.segments(raw, 20, 6, none))]
    hashes, counts = np.unique(plain[3], return_counts=True)
    often = np.sort(hashes[counts > np.quantile(counts, 0.9)])
    picks: dict[bytes, set] = {}
    total = 0
    for s in suffixes.segments(raw, 20, 6, often):
        for text, start, windows, anchor in zip(s.text, s.start, s.windows, s.anchor):
            total += windows
            for k in range(windows):
                picks.setdefault(raw[text][start + k : start + k + 20], set()).add(int(anchor))
    assert total == sum(len(r) - 19 for r in raw) and all(len(p) == 1 for p in picks.values())


def test_bucket_pointers():
    rng = random.Random(3)
    for _ in range(80):
        letters, span = rng.choice([1, 2, 4, 26]), rng.choice([3, 8, 10, 25, 100])
        data = bytes(rng.randrange(letters) + 97 for _ in range(rng.randrange(span, 300)))
        starts = np.array(sorted(rng.sample(range(len(data) - span + 1), rng.randrange(1, len(data) - span + 2))))
        pointers = suffixes.equal_windows(np.frombuffer(data, np.uint8), starts, span)
        of = {}
        for s, p in zip(starts, pointers):
            of.setdefault(data[s : s + span], set()).add(int(p))
        assert all(len(p) == 1 for p in of.values()) and len({min(p) for p in of.values()}) == len(of)


def test_texts_beyond_a_slice(monkeypatch):
    raw = [b"".join(hashlib.md5(bytes([k % 7, j])).digest() for j in range(200)) for k in range(9)]
    whole = list(suffixes.segments(raw, 100, 24, np.zeros(0, np.uint64)))
    monkeypatch.setattr(suffixes, "SLICE", 1024)
    monkeypatch.setattr(suffixes, "_PLACE", np.uint64(1023))
    cut = list(suffixes.segments(raw, 100, 24, np.zeros(0, np.uint64)))
    places = lambda parts: {(int(t), int(a) + k) for s in parts for t, a, w in zip(s.text, s.start, s.windows) for k in range(w)}
    assert places(whole) == places(cut) == {(t, a) for t, r in enumerate(raw) for a in range(len(r) - 99)}
