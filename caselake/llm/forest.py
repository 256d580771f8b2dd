"""Forests of common prefixes of sorted sequences, built by union-find over neighbours' LCPs.

A sequence is a byte string of ``TOKEN`` bytes per step: a 16-byte digest and 4 bytes of weight. Every
sequence is a leaf of the union-find; the edge between neighbours carries their common steps. Edges are
taken in descending depth: joining two components makes the node at which they branch (or adds to the
one just made there). What lies strictly inside a block of sequences is final. The nodes above its first
and its last sequence may reach beyond it: they are contracted to marks, which hold all that was
closed below them, and blocks side by side are merged by the same steps over their first and last
sequences and marks.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

TOKEN = 20
DIGEST = 16


class Mark(NamedTuple):
    """What hangs at a node of the first (``right`` false) or last sequence of a block."""

    right: bool
    depth: int
    n: int
    least: int | None
    leaves: int
    saved: int
    children: int
    ends: str | None
    end_key: bytes | None


class Node(NamedTuple):
    """One closed node; a chain of single children above it is written out."""

    conv_id: int
    depth: int
    parent_conv_id: int | None
    parent_key: bytes | None
    n_convs: int
    n_children: int
    n_leaves: int
    saved_tokens: int
    ends: str | None
    end_key: bytes | None
    key: bytes | None


def common_steps(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b)) // TOKEN
    while low < high:
        mid = (low + high + 1) // 2
        if a[: mid * TOKEN] == b[: mid * TOKEN]:
            low = mid
        else:
            high = mid - 1
    return low


def prefix_key(sequence: bytes, depth: int) -> bytes:
    return hashlib.md5(sequence[: depth * TOKEN]).digest()


def _weight(sequence: bytes, step: int) -> int:
    return int.from_bytes(sequence[step * TOKEN + DIGEST : (step + 1) * TOKEN], "big")


class _Open:
    __slots__ = ("depth", "leaf", "left", "right", "n", "least", "leaves", "saved", "children", "ends", "end_key", "own")

    def __init__(self, depth: int, leaf: int):
        self.depth, self.leaf, self.left, self.right = depth, leaf, leaf, leaf
        self.n = self.leaves = self.saved = self.children = 0
        self.least = self.ends = self.end_key = None
        self.own = True  # false once its values went to another node of the same place

    def add(self, n, least, leaves, saved, children, ends=None, end_key=None):
        self.n += n
        self.leaves += leaves
        self.saved += saved
        self.children += children
        if least is not None and (self.least is None or least < self.least):
            self.least = least
        self.ends, self.end_key = ends or self.ends, end_key or self.end_key


def grow(
    sequences: list[bytes], marks: list[tuple[int, Mark]], whole: bool, keyed: bool
) -> tuple[list[Node], list[Mark]]:
    """Closed nodes and the marks that are left. ``marks`` are (sequence, mark); ``whole``: nothing lies
    outside, so that every node is closed; ``keyed``: nodes carry a digest that others may refer to."""
    last = len(sequences) - 1
    above = list(range(len(sequences)))
    lows, highs = list(above), list(above)
    top: list[_Open | None] = [None] * len(sequences)
    at: dict[int, tuple[list, list]] = {0: ([(0, Mark(False, 0, 0, None, 0, 0, 0, None, None))], [])}
    for leaf, mark in marks:
        at.setdefault(mark.depth, ([], []))[0].append((leaf, mark))
    for k in range(last):
        at.setdefault(common_steps(sequences[k], sequences[k + 1]), ([], []))[1].append(k)
    closed: list[tuple[_Open, _Open | None]] = []
    merged: dict[int, _Open] = {}

    def find(x: int) -> int:
        while above[x] != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    def reaches_out(node: _Open) -> bool:
        return not whole and (node.left == 0 or node.right == last)

    def hang(child: _Open | None, node: _Open) -> None:
        if child is None:
            return
        if reaches_out(child):
            opened.append(child)
            return
        leaves = child.leaves if child.children else 1
        weight = sum(_weight(sequences[child.leaf], s) for s in range(node.depth, child.depth))
        node.add(child.n, child.least, leaves, child.saved + (child.n - 1) * weight, 1)
        closed.append((child, node))

    def node_of(root: int, depth: int) -> _Open:
        node = top[root]
        if node is None or node.depth != depth:
            fresh = _Open(depth, lows[root])
            hang(node, fresh)
            node = top[root] = fresh
        node.left, node.right = lows[root], highs[root]
        return node

    opened: list[_Open] = []
    for depth in sorted(at, reverse=True):
        for leaf, mark in at[depth][0]:
            node_of(find(leaf), depth).add(*mark[2:])
        for k in at[depth][1]:
            a, b = find(k), find(k + 1)
            one, other = node_of(a, depth), node_of(b, depth)
            one.add(other.n, other.least, other.leaves, other.saved, other.children, other.ends, other.end_key)
            other.own, merged[id(other)] = False, one
            above[b] = a
            highs[a] = highs[b]
            one.right = highs[a]
    root = top[find(0)]
    if whole:
        closed.append((root, None))
    else:
        opened.append(root)

    def kept(node: _Open) -> _Open:
        while not node.own:
            node = merged[id(node)]
        return node

    nodes: list[Node] = []
    for child, parent in closed:
        sequence, parent_id, parent_key, start = sequences[child.leaf], None, None, 0
        if parent is not None:
            parent = kept(parent)
            start = parent.depth + 1
            if reaches_out(parent):
                parent_key = prefix_key(sequence, parent.depth)
            else:
                parent_id = parent.least
        leaves, saved, children = (child.leaves if child.children else 1), child.saved, child.children
        ends, end_key, key = child.ends, child.end_key, prefix_key(sequence, child.depth) if keyed else None
        for depth in range(child.depth, start - 1, -1):
            if depth:
                saved += (child.n - 1) * _weight(sequence, depth - 1)
            first = depth == start
            nodes.append(
                Node(child.least, depth, parent_id if first else child.least, parent_key if first else None, child.n, children, leaves, saved, ends, end_key, key)
            )
            children, ends, end_key, key = 1, None, None, None
    rest = [Mark(n.left != 0, n.depth, n.n, n.least, n.leaves, n.saved, n.children, n.ends, n.end_key) for n in opened]
    return nodes, rest
