"""Chat formatting by prefix-target expansion (operator 10).

Every assistant turn becomes an example of its own: all earlier turns are context, and only that
reply is trainable. What follows the last assistant turn (or a conversation without one) becomes
one more example with nothing trainable, so that no turn is lost.

A turn is written as ``<turn role="R">T</turn>`` and a line end. In R and T, ``&``, ``<`` and ``"``
are written ``&amp;``, ``&lt;`` and ``&quot;``: a text can therefore hold no marker, and reading back
is exact. The loss mask is the span ``[loss_start, loss_end)`` of characters of ``formatted``.

Turns are ordered by turn, role, text, nulls first; a null text or role counts as empty; a null
conv_id is a conversation; repeated rows are turns of their own; an empty table gives no example.
An example holds its whole context, so one conversation is gathered in one row by definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.registry import query, table

TARGET_ROLE = "assistant"
CLOSE = "</turn>\n"


def escape(text: Column) -> Column:
    for plain, written in (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in (('"', "&quot;"), ("<", "&lt;"), ("&", "&amp;")):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def expand(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, example (from 1), n_turns, formatted, loss_start, loss_end, tail: one row per example.

    ``loss_start`` = ``loss_end`` in the example of a tail. ``tail`` is true for the example that
    holds every turn of its conversation.
    """
    empty = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    turns = conversations.select(
        F.col(f"`{conv}`").alias("conv_id"),
        F.struct(F.col(f"`{turn}`").alias("turn"), empty(role).alias("role"), empty(text).alias("text")).alias("t"),
    )
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    opened = lambda t: F.concat(F.lit('<turn role="'), escape(t["role"]), F.lit('">'))
    written = gathered.select(
        "conv_id",
        F.size("turns").alias("n"),
        F.transform("turns", lambda t: t["role"]).alias("roles"),
        F.transform("turns", lambda t: F.concat(opened(t), escape(t["text"]), F.lit(CLOSE))).alias("written"),
        F.transform("turns", lambda t: F.char_length(opened(t))).alias("heads"),
    )
    ends = F.filter(
        F.sequence(F.lit(1), F.col("n")),
        lambda i: (F.element_at("roles", i) == TARGET_ROLE) | (i == F.col("n")),
    )
    one = written.select("*", F.posexplode(ends).alias("p", "end"))
    examples = one.select(
        "conv_id",
        (F.col("p") + 1).cast("long").alias("example"),
        F.col("end").cast("long").alias("n_turns"),
        F.array_join(F.slice("written", 1, F.col("end")), "").alias("formatted"),
        F.element_at("written", F.col("end")).alias("last"),
        F.element_at("heads", F.col("end")).alias("head"),
        (F.element_at("roles", F.col("end")) == TARGET_ROLE).alias("trains"),
        (F.col("end") == F.col("n")).alias("tail"),
    )
    start = F.char_length("formatted") - F.char_length("last") + F.col("head")
    stop = F.char_length("formatted") - len(CLOSE)
    return examples.select(
        "conv_id", "example", "n_turns", "formatted",
        F.when(F.col("trains"), start).otherwise(0).cast("long").alias("loss_start"),
        F.when(F.col("trains"), stop).otherwise(0).cast("long").alias("loss_end"),
        "tail",
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Digests of what the formatted examples hold, per conversation."""
    turn = r'<turn role="([^"]*)">([^<]*)</turn>\n'
    roles = F.regexp_extract_all("formatted", F.lit(turn), 1)
    texts = F.regexp_extract_all("formatted", F.lit(turn), 2)
    lines = F.zip_with(roles, texts, lambda r, t: F.concat(unescape(r), F.lit("\n"), unescape(t), F.lit("\n")))
    loss = F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    read = examples.select(
        "conv_id",
        "example",
        F.char_length("formatted").alias("chars"),
        unescape(loss).alias("loss"),
        F.when(F.col("tail"), F.size(roles)).alias("n_turns"),
        F.when(F.col("tail"), F.sha2(F.array_join(lines, ""), 256)).alias("turns"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("example", "loss")))
    joined = read.groupBy("conv_id").agg(
        F.max("n_turns").cast("long").alias("n_turns"),
        F.max("turns").alias("turns_sha256"),
        F.array_join(F.transform(ordered, lambda x: x["loss"]), "").alias("loss"),
        F.sum("chars").cast("long").alias("formatted_chars"),
    )
    return joined.select(
        "conv_id", "n_turns", "turns_sha256",
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


OP10_SQL = r"""
WITH a AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e AS (
  SELECT *, length(role) + length(text) + 4 * (length(role || text) - length(replace(role || text, '&', '')))
       + 3 * (length(role || text) - length(replace(role || text, '<', '')))
       + 5 * (length(role || text) - length(replace(role || text, '"', ''))) + length('<turn role="">') + length('</turn>') + 1 AS chars,
       row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n
  FROM a WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
p AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS prefix FROM e)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(prefix) FILTER (role = 'assistant' OR i = n)::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
"""


@query("op10_chat_prefix_targets", OP10_SQL)
def op10_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], said.schema)
    return read_back(expand(said.unionByName(own)))
