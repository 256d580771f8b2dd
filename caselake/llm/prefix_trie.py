"""Prefix trie of conversations (operator 11).

Conversations become sequences of turn digests. One range sort by (sequence, id) puts shared prefixes
side by side. Every task cuts its sorted rows into blocks and builds the forest of each block by
union-find over the LCPs of neighbours, in descending depth (forest.py). A block hands on its finished
nodes and a contracted forest: its first and last sequence and what hangs on the nodes above them.
Contracted forests side by side are merged, ``FAN`` at a time, until one is left; that closes the rest.

Copies of one conversation are sorted by id, so a conversation with a third of all rows spans many
blocks and tasks, and is merged like any other prefix. The digest of the ids that end at a node is computed
in the block if the sequence ends within it. Ids of a sequence at the edge of a block are joined to
pieces of text there, and the pieces of one sequence are hashed in order by one task, as a stream.

Defined results: rows without conversation id belong to no conversation; null roles and texts are
empty; turns are ordered by turn, nulls first, equal turns by the digest of role and text; repeated rows
are turns of their own; further columns are ignored; an empty table has no node. A conversation is
held as one row of 20 bytes per turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.forest import Mark, grow
from caselake.llm.registry import query, table
from caselake.operators.joins import lookup_join
from caselake.session import materialise

BLOCK_ROWS = 20_000
BLOCK_BYTES = 16 << 20
FAN = 64
NO_ENDS = hashlib.sha256(b"").hexdigest()
_MARK = pa.struct([("right", pa.bool_()), ("depth", pa.int32()), *[(c, pa.int64()) for c in ("n", "least", "leaves", "saved", "children")], ("ends", pa.string()), ("end_key", pa.binary())])
_MARKS = "array<struct<right:boolean,depth:int,n:bigint,least:bigint,leaves:bigint,saved:bigint,children:bigint,ends:string,end_key:binary>>"
_FIELDS = {
    "kind": "string", "conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "parent_key": "binary", "n_convs": "bigint",
    "n_children": "bigint", "n_leaves": "bigint", "saved_tokens": "bigint", "ends": "string", "end_key": "binary", "key": "binary",
    "part": "bigint", "block": "bigint", "first": "binary", "last": "binary", "single": "boolean", "marks": _MARKS,
    "first_id": "bigint", "ids": "string",
}
SCHEMA = ", ".join(f"{name} {kind}" for name, kind in _FIELDS.items())
_NODE = ["conv_id", "depth", "parent_conv_id", "parent_key", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "end_key", "key"]
_FOREST = ["part", "block", "first", "last", "single", "marks"]
_PIECE = ["end_key", "first_id", "ids"]


def _arrow_schema() -> pa.Schema:
    types = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), _MARKS: pa.list_(_MARK)}
    return pa.schema([(name, types[kind]) for name, kind in _FIELDS.items()])


def _batch(kind: str, names: list[str], rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    schema = _arrow_schema()
    for a in range(0, len(rows), 50_000):
        part = rows[a : a + 50_000]
        columns = dict(zip(names, zip(*part)))
        columns["kind"] = [kind] * len(part)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(columns[f.name]), f.type) if f.name in columns else pa.nulls(len(part), f.type) for f in schema], schema=schema
        )


def _pair(mark: Mark) -> dict:
    return mark._asdict()


def _grown(sequences, marks, whole, keyed, part, block) -> Iterator[pa.RecordBatch]:
    nodes, rest = grow(sequences, marks, whole, keyed)
    yield from _batch("node", _NODE, [tuple(n) for n in nodes])
    if not whole:
        yield from _batch("forest", _FOREST, [(part, block, sequences[0], sequences[-1], len(sequences) == 1, [_pair(m) for m in rest])])


def _blocks(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.RecordBatch]:
    """Rows (sequence, conv_id), sorted -> nodes, contracted forests and pieces of id lists."""
    part, block, size, rows = TaskContext.get().partitionId(), 0, 0, []

    def flush():
        sequences, groups = [], []
        for sequence, conv in rows:
            if not sequences or sequences[-1] != sequence:
                sequences.append(sequence)
                groups.append([])
            groups[-1].append(conv)
        marks, pieces = [], []
        for k, (sequence, ids) in enumerate(zip(sequences, groups)):
            text, ends, key = ",".join(map(str, ids)), None, None
            if 0 < k < len(sequences) - 1:
                ends = hashlib.sha256(text.encode()).hexdigest()
            else:
                key = hashlib.md5(sequence).digest()
                pieces.append((key, ids[0], text))
            marks.append((k, Mark(False, len(sequence) // 20, len(ids), ids[0], 0, 0, 0, ends, key)))
        yield from _grown(sequences, marks, False, False, part, block)
        yield from _batch("piece", _PIECE, pieces)

    for batch in batches:
        for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows.append(row)
            size += len(row[0])
            if len(rows) >= block_rows or size >= BLOCK_BYTES:
                yield from flush()
                block, size, rows = block + 1, 0, []
    if rows:
        yield from flush()


def _merged(whole: bool, group: str, fan: int):
    def merge(forests: pa.Table) -> pa.Table:
        given = sorted(forests.to_pylist(), key=lambda r: (r["part"], r["block"]))
        sequences, marks = [], []
        for f in given:
            left = len(sequences)
            sequences += [f["first"]] if f["single"] else [f["first"], f["last"]]
            marks += [(len(sequences) - 1 if m["right"] else left, Mark(**m)) for m in f["marks"]]
        part, block = (given[0]["part"], given[0]["block"] // fan) if group == "block" else (given[0]["part"] // fan, 0)
        return pa.Table.from_batches(list(_grown(sequences, marks, whole, True, part, block)), _arrow_schema())

    return merge


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (end_key, first_id) -> one digest per end_key, hashed as they come."""
    key, state = None, None
    for batch in batches:
        done = []
        for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.binary(), pa.string()))], ["end_key", "digest"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["end_key", "digest"])


def prefix_trie(sequences: DataFrame, block_rows: int = BLOCK_ROWS, fan: int = FAN) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    ``sequences``: (sequence binary, conv_id long), ids not null and different. A node is known by its
    smallest member and its depth.
    """
    ordered = sequences.select("sequence", "conv_id").repartitionByRange("sequence", "conv_id").sortWithinPartitions("sequence", "conv_id")
    level = materialise(ordered.mapInArrow(lambda batches: _blocks(batches, block_rows), SCHEMA), "trie_blocks", ("kind",))
    levels = [level]
    forests = level.filter("kind = 'forest'").select(*_FOREST)
    while True:
        blocks, furthest = forests.agg(F.count("*"), F.max("block")).first()
        if not blocks:
            break
        whole, group = blocks <= fan, "block" if furthest else "part"
        if whole:
            keys = [F.lit(0).alias("g"), F.lit(0).alias("h")]
        elif group == "block":
            keys = [F.col("part").alias("g"), F.floor(F.col("block") / fan).alias("h")]
        else:
            keys = [F.floor(F.col("part") / fan).alias("g"), F.lit(0).alias("h")]
        merged = forests.groupBy(*keys).applyInArrow(_merged(whole, group, fan), SCHEMA)
        levels.append(materialise(merged, "trie_merge", ("kind",)))
        forests = levels[-1].filter("kind = 'forest'").select(*_FOREST)
        if whole:
            break
    nodes = levels[0].filter("kind = 'node'").select(*_NODE)
    later = None
    for one in levels[1:]:
        found = one.filter("kind = 'node'").select(*_NODE)
        later = found if later is None else later.unionByName(found)
    if later is None:
        return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.lit(NO_ENDS).alias("ends_sha256"))
    nodes = nodes.unionByName(later)
    # children of nodes that a later merge closed, and ends hashed apart: a few per block
    parents = later.filter("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    pieces = level.filter("kind = 'piece'").select("end_key", "ids", "first_id")
    streams = pieces.repartition("end_key").sortWithinPartitions("end_key", "first_id").select("end_key", "ids")
    digests = materialise(streams.mapInArrow(_digests, "end_key binary, digest string"), "trie_ends")
    referring = lookup_join(nodes.filter("parent_key is not null or end_key is not null"), parents, ["parent_key"])
    referring = lookup_join(referring, digests, ["end_key"]).select(
        *[F.coalesce("parent_conv_id", "_parent").alias(c) if c == "parent_conv_id" else F.coalesce("ends", "digest").alias(c) if c == "ends" else c for c in _NODE]
    )
    every = nodes.filter("parent_key is null and end_key is null").unionByName(referring)
    return every.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256")
    )


def turn_lists(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turns: one 40-digit text per turn, the digest of role and text and the text's code points."""
    said = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    r, t = said(role), said(text)
    digest = F.md5(F.concat(F.char_length(r).cast("string"), F.lit(" "), r, t))
    token = F.concat(digest, F.lpad(F.lower(F.hex(F.char_length(t))), 8, "0"))
    one = F.struct(F.col(f"`{turn}`").alias("turn"), token.alias("token"))
    told = conversations.filter(F.col(f"`{conv}`").isNotNull()).select(F.col(f"`{conv}`").cast("long").alias("conv_id"), one.alias("t"))
    return told.groupBy("conv_id").agg(F.sort_array(F.collect_list("t"))["token"].alias("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, sequence: the first few turns come from the conversation at the head of the hundred."""
    turns = materialise(turns, "turn_lists")
    hub = F.col("conv_id") - F.col("conv_id") % 100
    h = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int")
    heads = turns.filter("conv_id % 100 = 0").select(F.col("conv_id").alias("hub"), F.slice("turns", 1, 5).alias("head"))
    own = turns.withColumns({"hub": hub, "h": h}).join(heads, "hub", "left")  # a head serves at most 199 ids
    led = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h"))).otherwise(F.array().cast("array<string>"))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return own.select("conv_id", F.unhex(F.array_join(F.concat(led, rest), "")).alias("sequence"))


_CRC = """list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda s, b: list_reduce([xor(s, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END))"""
OP11_SQL = f"""
WITH t AS (
  SELECT conv_id, length(coalesce(text, '')) AS len, md5(length(coalesce(role, '')) || ' ' || coalesce(role, '') || coalesce(text, '')) AS token, turn
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, token, len) AS i FROM t),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS hub, xor({_CRC}, 4294967295::BIGINT) % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, i, 0 AS own, token, len FROM c JOIN o ON o.conv_id = c.hub AND o.i <= c.h
  UNION ALL SELECT c.conv_id, i, 1 AS own, token, len FROM c JOIN o ON o.conv_id = c.conv_id AND o.i > c.h),
s AS (SELECT conv_id, row_number() OVER w AS d, md5(string_agg(token, '') OVER w) AS node, len
      FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, i)),
p AS (
  SELECT conv_id, 0 AS d, '' AS node, 0 AS len FROM c UNION ALL SELECT * FROM s),
q AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY d) AS parent, max(d) OVER (PARTITION BY conv_id) AS size FROM p),
n AS (SELECT node, d, min(conv_id) AS conv_id, any_value(parent) AS parent, count(*) AS n_convs, any_value(len) AS len,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = size), '')) AS ends
      FROM q GROUP BY node, d),
k AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY parent),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (node)),
b AS (SELECT p.node, sum((m.n_convs - 1) * m.len) AS saved, count(*) FILTER (m.n_children = 0) AS n_leaves
      FROM m JOIN p ON p.conv_id = m.conv_id AND p.d <= m.d GROUP BY p.node)
SELECT m.conv_id::BIGINT AS conv_id, m.d::BIGINT AS depth, u.conv_id::BIGINT AS parent_conv_id, m.n_convs::BIGINT AS n_convs,
       m.n_children::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, m.ends AS ends_sha256
FROM m JOIN b USING (node) LEFT JOIN n u ON u.node = m.parent AND m.d > 0
"""


@query("op11_prefix_trie", OP11_SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(turn_lists(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))))
