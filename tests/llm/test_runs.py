"""Periodic runs against brute force: the grammar's extensions, the runs of short sequences, the query."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from caselake.llm import runs
from caselake.llm.recompression import Grammar

SF = "/root/testdata/sf0.001"


def by_brute_force(w):
    """(start, length, period) of all runs: for every period the maximal stretches, smallest period first."""
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(12, 2 * q):
                found.setdefault((s, i + q - s), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def sequences(seed):
    rng = random.Random(seed)
    for _ in range(150):
        kind, letters = rng.randrange(4), rng.choice([1, 2, 3, 40])
        w = [rng.randrange(letters) for _ in range(rng.randrange(0, 70))]
        if kind == 1:
            w += [rng.randrange(letters) for _ in range(rng.randrange(1, 8))] * rng.randrange(2, 9) + w[:5]
        if kind == 2:  # runs inside runs
            inner = [1] * rng.randrange(1, 15) + [2] * rng.randrange(0, 4)
            w += (inner * rng.randrange(1, 4) + [7]) * rng.randrange(2, 5)
        if kind == 3:
            a, b = [0], [1]
            for _ in range(rng.randrange(3, 9)):
                a, b = b, b + a
            w = b
        yield w


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_of_sequences(seed):
    given = list(sequences(seed))
    got = runs.find_runs([np.array(w, dtype=np.int64) for w in given])
    for w, (s, e, q) in zip(given, got):
        assert list(zip(s.tolist(), (e - s).tolist(), q.tolist())) == by_brute_force(w)


def test_long_texts_walk_the_grid_alike(monkeypatch):
    given = [np.array(w, dtype=np.int64) for w in sequences(9)]
    short = runs.find_runs(given)
    monkeypatch.setattr(runs, "TABLE_WORDS", 20)
    monkeypatch.setattr(runs, "_grid", runs._Grid())
    for a, b in zip(short, runs.find_runs(given)):
        assert all((x == y).all() for x, y in zip(a, b))


def test_extensions():
    rng = random.Random(4)
    for _ in range(40):
        s = np.array([0, *[rng.randrange(3) + 2 for _ in range(rng.randrange(2, 200))], 1])
        grammar = Grammar(s, s < 2)
        x = np.array([rng.randrange(len(s)) for _ in range(200)])
        y = (x + 1 + np.array([rng.randrange(len(s) - 1) for _ in range(200)])) % len(s)
        for step in (1, -1):
            for a, b, got in zip(x, y, grammar.extensions(x, y, step)):
                n = 0
                while 0 <= min(a, b) + step * n and max(a, b) + step * n < len(s) and s[a + step * n] == s[b + step * n]:
                    n += 1
                assert got == n


def test_query_on_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in runs.op13_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    planted = 0
    for d in docs:
        w = (d.text or "").encode().split()
        h = zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and w:
            n, g = len(w), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            planted += 1
        if len(w) > 2500:  # brute force is quadratic
            continue
        found = by_brute_force(w)
        gone = {k for s, length, q in found for k in range(s + q, s + length)}
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        r = got[d.doc_id]
        assert r.n_runs == len(found)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()
    assert planted


def test_odd_rows(odd):
    got = runs.periodic_runs(odd, odd.columns).collect()
    assert len(got) == odd.count() and runs.periodic_runs(odd.limit(0), odd.columns).collect() == []
    empty = [r for r in got if not (r.row["text"] or "").split()]
    assert empty and all((r.n_words, r.runs, r.collapsed) == (0, [], "") for r in empty)
    assert all(r.row["a.b"] in ("clash", None) for r in got)
