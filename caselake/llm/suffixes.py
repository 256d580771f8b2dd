"""Numpy parts of suffix-array deduplication: anchored segments of texts, and bucket-pointer refinement.

*Segments.* Every window of ``span`` bytes picks one of its q-grams, the one with the smallest hash
(the leftmost of equal ones; grams of a given list of very frequent ones only if there is no other).
The choice depends on the window alone, so equal windows pick the same gram at the same place: it is
their initial bucket. Neighbouring windows mostly pick the same gram and form a segment.

*Bucket-pointer refinement.* All suffixes of a pool of segments are put into buckets by their first
``Q`` bytes; a suffix's bucket pointer is the place of its bucket in the suffix array. Every bucket with
more than one suffix is refined by sorting on the pointers found ``depth`` bytes further on. Pointers
are updated in place, so each round reuses what the rounds before found for later offsets and the
sorted depth doubles; suffixes alone in their bucket are not sorted again.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

from caselake.llm.shingles import mix

Q = 8
SLICE = 1 << 20
_PLACE = np.uint64(SLICE - 1)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_LETTERS = [mix(np.arange(1 + 1000 * k, 257 + 1000 * k, dtype=np.uint64)) for k in range(2)]
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _power(kind: int) -> tuple[np.ndarray, np.ndarray]:
    while len(_powers) < 2:
        base = _BASES[len(_powers)]
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(SLICE, b, dtype=np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        _powers.append(tuple(both))
    return _powers[kind]


class _Sums:
    """Polynomial hashes of any stretch of one slice."""

    def __init__(self, data: np.ndarray, kind: int):
        up, self.down = _power(kind)
        self.total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_LETTERS[kind][data] * up[: len(data)], dtype=np.uint64, out=self.total[1:])

    def of(self, start: np.ndarray | slice, stop: np.ndarray | slice) -> np.ndarray:
        return (self.total[stop] - self.total[start]) * self.down[start]


class Segments(NamedTuple):
    text: np.ndarray  # number of the text
    start: np.ndarray  # first window's place in it
    windows: np.ndarray
    anchor: np.ndarray  # hash of the gram that all of the windows pick
    content: np.ndarray  # hash of all their bytes


def _slices(sizes: list[int], span: int) -> Iterator[list[tuple[int, int, int]]]:
    """Pieces (text, from, to) of at most ``SLICE`` bytes in all; pieces of one text overlap by span - 1."""
    room, out = SLICE, []
    for k, size in enumerate(sizes):
        a = 0
        while size - a >= span:
            if room < min(size - a, SLICE // 2):
                yield out
                room, out = SLICE, []
            b = min(size, a + room)
            out.append((k, a, b))
            room -= b - a
            a = b - span + 1
    if out:
        yield out


def segments(raw: list[bytes], span: int, gram: int, frequent: np.ndarray) -> Iterator[Segments]:
    """Segments of all windows, in order of (text, start). ``frequent``: sorted hashes of grams to avoid."""
    for pieces in _slices([len(r) for r in raw], span):
        data = np.frombuffer(b"".join(raw[k][a:b] for k, a, b in pieces), dtype=np.uint8)
        n = len(data)
        size = np.array([b - a for _, a, b in pieces])
        end = np.cumsum(size)
        sums = _Sums(data, 0)
        grams = mix(sums.of(slice(0, n - gram + 1), slice(gram, n + 1)))
        ranked = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
            high = np.uint64(1 << 63)
            ranked = np.where(frequent[at] == grams, ranked | high, ranked & ~high)
        width, least = 1, ranked
        want = span - gram + 1
        while width < want:
            step = min(width, want - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        pick = (least & _PLACE).astype(np.int64)
        left = np.repeat(end, size)[: len(pick)] - np.arange(len(pick))
        valid = left >= span
        change = np.ones(len(pick), dtype=bool)
        change[1:] = (pick[1:] != pick[:-1]) | ~valid[:-1]
        first = np.flatnonzero(change & valid)
        closing = np.flatnonzero(change | ~valid)
        after = np.append(closing, len(pick))
        last = after[np.searchsorted(closing, first) + 1]
        piece = np.searchsorted(end, first, side="right")
        begin = end - size
        stop = last + span - 1
        content = _Sums(data, 1).of(first, stop)
        content = mix(content + mix((stop - first).astype(np.uint64)))
        texts, offsets = np.array([k for k, _, _ in pieces]), np.array([a for _, a, _ in pieces])
        yield Segments(texts[piece], first - begin[piece] + offsets[piece], last - first, grams[pick[first]], content)


def equal_windows(data: np.ndarray, starts: np.ndarray, span: int) -> np.ndarray:
    """Bucket pointers of the suffixes at ``starts`` at depth ``span``: equal for equal windows."""
    n = len(data)
    padded = np.zeros(n + Q, dtype=np.uint8)
    padded[:n] = data
    depth = min(Q, span)
    words = np.zeros(n, dtype=np.uint64)
    for k in range(depth):
        words = (words << np.uint64(8)) | padded[k : k + n]
    array = np.argsort(words)
    ordered = words[array]
    new = np.ones(n, dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    pointer = np.empty(n, dtype=np.int64)
    pointer[array] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    wanted = np.zeros(n, dtype=bool)
    wanted[starts] = True
    while depth < span:
        step = min(depth, span - depth)
        alone = new & np.append(new[1:], True)
        active = np.flatnonzero(~alone)  # places in the suffix array whose bucket holds several
        if depth + step >= span:  # nothing builds on the last round
            active = active[wanted[array[active]]]
        if not len(active):
            break
        suffix = array[active]
        key = (pointer[suffix] << 32) | pointer[np.minimum(suffix + step, n - 1)]
        order = np.argsort(key)
        suffix, key = suffix[order], key[order]
        array[active] = suffix
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        new[active] = fresh
        pointer[suffix] = active[np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))]
        depth += step
    return pointer[starts]
