"""Word-shingle sets of whole texts as sorted 64-bit numbers, computed for batches with numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

CHUNK_BYTES = 1 << 20
_LOW = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_ODD = 0x9E3779B97F4A7C15
_BASE = np.uint64(_ODD)
_BACK = np.uint64(pow(_ODD, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LETTER = mix(np.arange(1, 257, dtype=np.uint64))
_PLACE = mix(np.arange(1001, 1001 + 64, dtype=np.uint64)) | np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 2 * CHUNK_BYTES)
        for k, base in enumerate((_BASE, _BACK)):
            _powers[k] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base)]), dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def _chunks(raw: Sequence[bytes]) -> Iterator[tuple[int, int]]:
    a = size = 0
    for b, r in enumerate(raw):
        if size and size + len(r) > CHUNK_BYTES:
            yield a, b
            a, size = b, 0
        size += len(r) + 1
    if a < len(raw):
        yield a, len(raw)


def shingle_sets(texts: Sequence[str | None], words: int = 5) -> Iterator[np.ndarray]:
    """For each text its distinct shingles, sorted; fewer words than ``words`` make one shingle, none none."""
    raw = [(t or "").encode().translate(_LOW) for t in texts]
    for a, b in _chunks(raw):
        yield from _sets_of(raw[a:b], words)


def _sets_of(raw: Sequence[bytes], words: int) -> Iterator[np.ndarray]:
    data = np.frombuffer(b" ".join([b"", *raw, b""]), dtype=np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw])  # the blank after each text
    blank = _BLANK[data]
    start = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    stop = np.flatnonzero(~blank[:-1] & blank[1:])  # last byte of the word
    up, down = _power(len(data))
    total = np.cumsum(_LETTER[data] * up, dtype=np.uint64)
    word = mix((total[stop] - total[start - 1]) * down[start] + (stop - start).astype(np.uint64))
    last = np.searchsorted(start, ends)  # words before the end of each text
    n = len(word) - words + 1
    whole = np.zeros(max(0, n), dtype=np.uint64)
    for k in range(words):
        whole += word[k : k + len(whole)] * _PLACE[k]
    whole = mix(whole)
    first = 0
    for end in last.tolist():
        if end - first >= words:
            s = np.sort(whole[first : end - words + 1])
            keep = np.ones(len(s), dtype=bool)
            keep[1:] = s[1:] != s[:-1]
            yield s[keep]
        elif end > first:
            k = end - first
            yield mix((word[first:end] * _PLACE[:k]).sum(dtype=np.uint64, keepdims=True) + _PLACE[32 + k])
        else:
            yield np.zeros(0, np.uint64)
        first = end
