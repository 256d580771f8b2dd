"""Prefix trie against brute force, with blocks and merges of every size."""

import hashlib
import random

import pytest

from caselake.llm import prefix_trie as trie
from caselake.llm.forest import common_steps


def token(letter):
    return hashlib.md5(letter.encode()).digest() + (ord(letter) - 90).to_bytes(4, "big")


def by_brute_force(told):
    """told: {conv: string of letters}; a letter is a turn of weight ord - 90."""
    members = {}
    for conv, letters in told.items():
        for d in range(len(letters) + 1):
            members.setdefault(letters[:d], []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def below(node):
        leaves, saved = (0, 0) if node in children else (1, 0)
        for child in children.get(node, []):
            a, b = below(child)
            leaves, saved = leaves + a, saved + b
        return leaves, saved + ((len(members[node]) - 1) * (ord(node[-1]) - 90) if node else 0)

    rows = set()
    for node, convs in members.items():
        leaves, saved = below(node)
        ends = ",".join(str(c) for c in sorted(convs) if told[c] == node)
        parent = min(members[node[:-1]]) if node else None
        rows.add((min(convs), len(node), parent, len(convs), len(children.get(node, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def conversations(seed):
    rng = random.Random(seed)
    told, pool = {}, [""]
    for conv in rng.sample(range(-500, 5000), 260):
        kind = rng.random()
        if kind < 0.3:
            letters = "abcabcab"  # one very common conversation
        elif kind < 0.6:
            letters = rng.choice(pool)[: rng.randrange(0, 9)] + "".join(rng.choice("abc") for _ in range(rng.randrange(0, 4)))
        else:
            letters = "".join(rng.choice("abcdz") for _ in range(rng.randrange(0, 8)))
        pool.append(letters)
        told[conv] = letters
    return told


@pytest.mark.parametrize("seed, block_rows, fan", [(1, 20_000, 64), (2, 5, 2), (3, 1, 3), (4, 30, 64), (5, 2, 2)])
def test_tries(spark, seed, block_rows, fan):
    told = conversations(seed)
    rows = [(bytearray(b"".join(map(token, letters))), conv) for conv, letters in told.items()]
    given = spark.createDataFrame(rows, "sequence binary, conv_id long").repartition(7)
    got = trie.prefix_trie(given, block_rows, fan).collect()
    assert len(got) == len({(r.conv_id, r.depth) for r in got})
    assert {tuple(r) for r in got} == by_brute_force(told)


def test_common_steps():
    for a, b, n in (("", "", 0), ("abc", "abd", 2), ("abc", "ab", 2), ("x", "y", 0), ("abcde", "abcde", 5)):
        assert common_steps(b"".join(map(token, a)), b"".join(map(token, b))) == n


def test_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, sequence string, depth long"
    data = [(None, 0, "user", "a", "x", 1), (7, None, None, None, "x", 1), (7, 1, "user", "b", None, None), (7, 1, "user", "b", "y", 2), (8, 0, "user", "é" * 50_000, "", 0)]
    told = spark.createDataFrame(data, schema)
    got = trie.prefix_trie(trie.rebuilt(trie.turn_lists(told)), block_rows=1).collect()
    # crc32("7") % 6 = 0 and crc32("8") % 6 = 5 turns are cut off the start; no conversation 0 leads them
    assert sorted((r.depth, r.conv_id, r.n_convs) for r in got) == [(0, 7, 2), (1, 7, 1), (2, 7, 1), (3, 7, 1)]
    assert trie.prefix_trie(trie.rebuilt(trie.turn_lists(told.limit(0)))).collect() == []
    assert [(r.conv_id, len(r.turns)) for r in trie.turn_lists(told).orderBy("conv_id").collect()] == [(7, 3), (8, 1)]
