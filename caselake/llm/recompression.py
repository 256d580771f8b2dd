"""A run-length grammar of a sequence by recompression, and exact extension queries on it.

Two steps alternate until next to nothing is left to shorten. Block compression replaces every
maximal stretch a, a, ..., a (k times) by one symbol for (a, k). Pair compression deals the symbols
into a left and a right half by a fixed hash and replaces every left symbol followed by a right one
by a symbol for the pair. What becomes of a place depends on its neighbours only, so equal stretches
are compressed alike but for a symbol at either end. An extension query ("how many symbols agree from
x and from y on?") therefore climbs while the symbols agree, stepping once per level where only one
of the two starts a parent, and then descends along the first difference: a few steps per level.

Queries are answered for whole arrays, level by level. Symbols below ``first_free`` that occur once
(separators between sequences) stop every query and are never replaced.
"""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Level:
    """One string of the grammar. ``up`` leads to the parent's index in the next string, ``first`` to
    the index of the first child in the string before (one more entry marks the end)."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, first: np.ndarray | None, block: bool):
        self.symbols, self.starts, self.first, self.block = symbols, starts, first, block
        self.up: np.ndarray | None = None


def _named(a: np.ndarray, b: np.ndarray, free: int) -> tuple[np.ndarray, int]:
    """One new symbol per distinct (a, b)."""
    keys, which = np.unique((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64), return_inverse=True)
    return which.astype(np.int64) + free, free + len(keys)


class Grammar:
    def __init__(self, symbols: np.ndarray, fixed: np.ndarray, most_levels: int = 400):
        """``fixed`` marks the separators; ``symbols`` starts and ends with one."""
        n = len(symbols)
        symbols = symbols.astype(np.int64)
        self.levels = [_Level(symbols, np.arange(n + 1), None, False)]
        free, separators = int(symbols.max()) + 1, int(fixed.sum())
        fixed, slow = fixed.copy(), 0
        while len(self.levels) < most_levels and slow < 8 and len(symbols) > 2 * separators:
            before = len(symbols)
            for block in (True, False):
                if block:
                    first = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
                else:
                    bit = (((symbols.astype(np.uint64) + np.uint64(len(self.levels))) * _ODD) >> np.uint64(43)) & np.uint64(1)
                    left, right = (bit == 0) & ~fixed, (bit == 1) & ~fixed
                    second = np.concatenate([[False], left[:-1] & right[1:]])
                    first = np.flatnonzero(~second)
                if len(first) == len(symbols):
                    continue
                edges = np.append(first, len(symbols))
                size = np.diff(edges)
                several = np.flatnonzero(size > 1)
                replaced = symbols[first]
                other = size[several] if block else symbols[first[several] + 1]
                replaced[several], free = _named(replaced[several], other, free)
                old = self.levels[-1]
                old.up = np.repeat(np.arange(len(first)), size)
                symbols, fixed = replaced, fixed[first]
                self.levels.append(_Level(symbols, old.starts[edges], edges, block))
            slow = slow + 1 if len(symbols) > 0.97 * before else 0

    def extensions(self, x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
        """How many symbols agree from (x, y) on, to the right (``step`` 1) or, reading x and y as the
        first places compared, to the left (-1). x <> y."""
        x, y, ids = x.copy(), y.copy(), np.arange(len(x))
        done = np.zeros(len(x), dtype=np.int64)
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for k, level in enumerate(self.levels):  # climb
            top = k + 1 == len(self.levels)
            out = [(ids[:0], x[:0], y[:0])]
            going = True
            while going and len(ids):
                same = level.symbols[x] == level.symbols[y]
                out.append((ids[~same], x[~same], y[~same]))
                ids, x, y = ids[same], x[same], y[same]
                if top:
                    aligned = np.zeros(len(ids), dtype=bool)
                else:
                    edge = self.levels[k + 1].first
                    px, py = level.up[x], level.up[y]
                    aligned = (edge[px] == x) & (edge[py] == y) if step > 0 else (edge[px + 1] == x + 1) & (edge[py + 1] == y + 1)
                going = not aligned.all()
                if going:
                    move = np.flatnonzero(~aligned)
                    a, b = x[move], y[move]
                    n = np.ones(len(move), dtype=np.int64)
                    if not top and self.levels[k + 1].block:  # to the nearer end of the two stretches
                        edge, pa, pb = self.levels[k + 1].first, level.up[a], level.up[b]
                        n = np.minimum(edge[pa + 1] - a, edge[pb + 1] - b) if step > 0 else np.minimum(a - edge[pa], b - edge[pb]) + 1
                    self._count(level, done, ids[move], a, n, step)
                    x[move], y[move] = a + step * n, b + step * n
            waiting.append(tuple(np.concatenate([o[c] for o in out]) for c in range(3)))
            if not top:
                x, y = level.up[x], level.up[y]
        ids = x = y = np.zeros(0, dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):  # descend: every pair differs on this level
            ids, x, y = (np.concatenate(c) for c in zip((ids, x, y), waiting[k]))
            if k == 0 or not len(ids):
                continue
            level, below = self.levels[k], self.levels[k - 1]
            a, b = (level.first[x], level.first[y]) if step > 0 else (level.first[x + 1] - 1, level.first[y + 1] - 1)
            same = np.flatnonzero(below.symbols[a] == below.symbols[b])
            if level.block:
                n = np.minimum(level.first[x + 1] - level.first[x], level.first[y + 1] - level.first[y])[same]
            else:
                n = np.ones(len(same), dtype=np.int64)
            self._count(below, done, ids[same], a[same], n, step)
            a[same], b[same] = a[same] + step * n, b[same] + step * n
            x, y = a, b
        return done

    @staticmethod
    def _count(level: _Level, done: np.ndarray, ids: np.ndarray, at: np.ndarray, n: np.ndarray, step: int) -> None:
        if step > 0:
            done[ids] += level.starts[at + n] - level.starts[at]
        else:
            done[ids] += level.starts[at + 1] - level.starts[at + 1 - n]
