"""Candidate pairs of company names that may be one company, for a person to review.

Only suggests, never merges. The score is the token-set ratio of two names: 100 if one name's
words are all in the other, else the best insert/delete similarity of (shared words, shared + rest
of a, shared + rest of b).

Comparing all pairs is avoided without losing any. A pair can reach the threshold in these ways, and
each leaves a trace that an equi join finds:

* the shared words cover almost all of one name. Then at least one of that name's rarest words,
  as many as may be missing plus one, is a word of the other name;
* the remaining words are spelled alike, and the names share a word that few names have: a join on
  such words, linear in the number of names;
* the remaining words are spelled alike, and all shared words are frequent ones. For every choice of
  its frequent words as the shared ones, a name has one remainder. With at most k letters to insert or
  delete, one of k + 1 segments of the shorter remainder is found unchanged in the longer one, at a
  place that k limits. Segments are joined on (shared words, length, k, segment number, letters).

What the last two find must also pass a comparison of letter counts before it is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import combinations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake.session import materialise

RARE_WORD = 64  # names: words of at most so many names are joined as they are
MOST_FREQUENT_WORDS = 8  # of one name; with more, its choices of shared words are too many
LETTER_GROUPS = 32
PARTNERS = 6  # places per name in the ranking; the name itself normally takes one of them


def _common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one bit per letter of ``a``."""
    seen: dict[str, int] = {}
    for i, letter in enumerate(a):
        seen[letter] = seen.get(letter, 0) | (1 << i)
    full = (1 << len(a)) - 1
    state = full
    for letter in b:
        match = state & seen.get(letter, 0)
        state = ((state + match) | (state - match)) & full
    return len(a) - state.bit_count()


def token_set_score(a: str, b: str) -> float:
    """0..100; word order and repeated words do not matter."""
    words_a, words_b = set(a.split()), set(b.split())
    if not words_a or not words_b:
        return 0.0
    shared = words_a & words_b
    rest_a, rest_b = " ".join(sorted(words_a - shared)), " ".join(sorted(words_b - shared))
    if shared and not (rest_a and rest_b):
        return 100.0
    base = len(" ".join(shared))
    gap = 1 if shared else 0
    full_a, full_b = base + gap + len(rest_a), base + gap + len(rest_b)
    changes = len(rest_a) + len(rest_b) - 2 * _common_length(rest_a, rest_b)
    best = 100.0 - 100.0 * changes / (full_a + full_b)
    if shared:
        for rest, full in ((rest_a, full_a), (rest_b, full_b)):
            best = max(best, 100.0 - 100.0 * (gap + len(rest)) / (base + full))
    return best


@F.pandas_udf(T.DoubleType())
def token_set_scores(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_score(x, y) for x, y in zip(a, b)], dtype="float64")


def _rarest_first(marks: DataFrame) -> DataFrame:
    """(id, mark, ..., place, weight_before): marks of a name from rare to frequent."""
    frequency = marks.groupBy("mark").agg(F.count("*").alias("names"))
    order = Window.partitionBy("id").orderBy("names", "mark")  # the marks of one name
    return marks.join(frequency, "mark").withColumns(
        {
            "place": F.row_number().over(order),
            "weight_before": F.coalesce(
                F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        }
    )


def _pairs(left: DataFrame, right: DataFrame, condition: Column) -> DataFrame:
    a = left.select(F.col("mark"), F.col("id").alias("id_a"), F.col("length").alias("length_a"))
    b = right.select(F.col("mark"), F.col("id").alias("id_b"), F.col("length").alias("length_b"))
    both = a.join(b, "mark").filter((F.col("id_a") != F.col("id_b")) & condition)
    return both.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))


def possible_pairs(names: DataFrame, min_score: float, rare_word: int = RARE_WORD) -> DataFrame:
    """(id_a, id_b), id_a < id_b: every pair that can score ``min_score`` or more, and some others.

    ``names`` has (id int, name). A word of at most ``rare_word`` names is joined as it is.
    """
    d = 1.0 - min_score / 100.0
    if not 0.0 <= d < 0.5:
        raise ValueError("min_score must be above 50")
    words = F.array_sort(F.array_distinct(F.filter(F.split("name", r"\s+"), lambda w: w != "")))
    worded = names.select("id", words.alias("words")).filter(F.size("words") > 0)
    sized = worded.withColumn("length", F.length(F.array_join("words", " ")))

    per_word = sized.select("id", "length", F.explode("words").alias("mark")).withColumn("weight", F.length("mark"))
    # letters of one name that may be missing from the shared words
    may_miss = F.greatest((F.lit(d) * (2 * F.col("length") - 1) - 1) / (1 + d), F.lit(0.0))
    rare_words = _rarest_first(per_word).filter(F.col("weight_before") <= may_miss + 1e-9)
    covered = _pairs(rare_words, per_word, F.lit(True))

    names_of_word = per_word.groupBy("mark").agg(F.count("*").alias("names"))
    rare = per_word.join(names_of_word.filter(F.col("names") <= rare_word), "mark")
    by_word = _pairs(rare, rare, F.col("id_a") < F.col("id_b"))

    frequent = per_word.join(names_of_word.filter(F.col("names") > rare_word), "mark")
    frequent = frequent.groupBy("id").agg(F.array_sort(F.collect_list("mark")).alias("frequent"))
    choices = sized.join(frequent, "id", "left").withColumn("frequent", F.coalesce("frequent", F.array().cast("array<string>")))
    choices = materialise(choices, "candidate_words")
    few = F.size("frequent") <= MOST_FREQUENT_WORDS
    keyed = choices.filter(few).select("id", "words", "frequent").mapInArrow(segment_keys(d), "id int, key long, longer boolean")
    keyed = materialise(keyed, "candidate_segments")
    shorter = keyed.filter("not longer").select("key", F.col("id").alias("id_a"))
    longer = keyed.filter("longer").select("key", F.col("id").alias("id_b"))
    met = shorter.join(longer, "key").filter("id_a <> id_b")
    alike = by_word.unionByName(met.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")))
    if choices.filter(~few).limit(1).count():
        alike = alike.unionByName(_by_letter_pairs(sized, choices.filter(~few).select("id"), d))

    letters = F.transform(F.filter(F.split(F.array_join("words", ""), ""), lambda c: c != ""), lambda c: F.ascii(c) % LETTER_GROUPS)
    counts = F.transform(F.sequence(F.lit(0), F.lit(LETTER_GROUPS - 1)), lambda i: F.size(F.filter("letters", lambda c: c == i)))
    bags = materialise(sized.withColumn("letters", letters).select("id", "length", counts.alias("bag")), "candidate_letters")
    left, right = (bags.select(*[F.col(c).alias(f"{c}_{x}") for c in ("id", "length", "bag")]) for x in "ab")
    apart = F.aggregate(F.zip_with("bag_a", "bag_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda t, x: t + x)
    likely = alike.distinct().join(left, "id_a").join(right, "id_b").filter(apart <= d * (F.col("length_a") + F.col("length_b")) + 1e-9)
    return covered.unionByName(likely.select("id_a", "id_b")).distinct()


def cut_evenly(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, length) of ``parts`` segments that differ by at most one letter."""
    edges = [length * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _keys(words: list[str], frequent: list[str], d: float) -> Iterator[tuple[str, bool]]:
    """(key, whether the name is the longer side) for every choice of shared words."""
    for n in range(len(frequent) + 1):
        for shared in combinations(frequent, n):
            rest = " ".join(w for w in words if w not in shared)
            if not rest:
                continue
            both, size = 2 * (len(" ".join(shared)) + (1 if shared else 0)), len(rest)
            start = " ".join(shared)
            changes = lambda other: int(d * (both + size + other) + 1e-9)  # noqa: B023, E731
            other, seen = size, set()
            while other - size <= changes(other):  # the shorter side: cut into segments
                k = changes(other)
                other += 1
                if k in seen:
                    continue
                seen.add(k)
                if k >= size:
                    yield f"{start}|{size}|{k}", False
                    continue
                for i, (a, m) in enumerate(cut_evenly(size, k + 1)):
                    yield f"{start}|{size}|{k}|{i}|{rest[a:a + m]}", False
            other = size
            while other > 0 and size - other <= changes(other):  # the longer side: look up at shifted places
                k, more = changes(other), size - other
                if k >= other:
                    yield f"{start}|{other}|{k}", True
                else:
                    for i, (a, m) in enumerate(cut_evenly(other, k + 1)):
                        for at in range(max(0, a - (k - more) // 2), min(size - m, a + (k + more) // 2) + 1):
                            yield f"{start}|{other}|{k}|{i}|{rest[at:at + m]}", True
                other -= 1


def segment_keys(d: float):
    """(id, words, frequent) -> (id, key, longer)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, words, frequent in zip(*(batch.column(k).to_pylist() for k in range(3))):
                keys = [(int.from_bytes(blake2b(k.encode(), digest_size=8).digest(), "big", signed=True), longer) for k, longer in set(_keys(words, frequent, d))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(keys), pa.int32()), pa.array([k for k, _ in keys], pa.int64()), pa.array([x for _, x in keys], pa.bool_())],
                    ["id", "key", "longer"],
                )

    return run


def _by_letter_pairs(sized: DataFrame, ids: DataFrame, d: float) -> DataFrame:
    """Pairs with one of ``ids`` that may be spelled alike: most of their letter pairs are the same, so the
    rarest of both, as many as may differ plus one, have one in common."""
    padded = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    letter_pairs = F.transform(
        F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substring(padded, i, F.lit(2))
    )
    counted = sized.select("id", "length", F.explode(letter_pairs).alias("pair")).groupBy("id", "length", "pair").agg(
        F.count("*").alias("times")
    )
    # the n-th occurrence of a letter pair is a mark of its own
    occurrences = F.transform(F.sequence(F.lit(1), F.col("times")), lambda n: F.concat("pair", n.cast("string")))
    marks = counted.select("id", "length", F.explode(occurrences).alias("mark"), F.lit(1).alias("weight"))
    may_differ = F.floor(F.col("length") * max(4 * d / (1 + d), 2 * d / (1 - d)) + 1e-9)
    rare_pairs = materialise(_rarest_first(marks).filter(F.col("place") <= may_differ + 1), "candidate_letter_pairs")
    longest = F.greatest("length_a", "length_b") * (1 - d) <= F.least("length_a", "length_b") * (1 + d) + 1e-9
    return _pairs(rare_pairs.join(ids, "id", "left_semi"), rare_pairs, longest)


def company_candidates(
    scorecard: DataFrame, top: int = 300, min_score: float = 88, places: int = PARTNERS
) -> DataFrame:
    """Pairs among the ``top`` companies by volume that score at least ``min_score``.

    As in any nearest-names list, a name keeps its ``places`` best entries, itself included; a pair
    is reported if either side lists the other. The decision column is left empty for a person.
    """
    ranked = scorecard.orderBy(F.desc("complaints"), "company").limit(top)
    numbered = ranked.select(  # at most ``top`` rows
        F.row_number().over(Window.orderBy(F.desc("complaints"), "company")).alias("id"),
        F.col("company").alias("name"),
        "complaints",
    )
    names = materialise(numbered, "candidate_names")
    a = names.select(F.col("id").alias("id_a"), F.col("name").alias("a"))
    b = names.select(F.col("id").alias("id_b"), F.col("name").alias("b"))
    scored = (
        possible_pairs(names.select("id", "name"), min_score)
        .join(a, "id_a")
        .join(b, "id_b")
        .withColumn("score", token_set_scores("a", "b"))
        .filter(F.col("score") >= min_score)
        .select("id_a", "id_b", "score")
    )
    scored = materialise(scored, "candidate_scores")
    both_ways = scored.unionByName(scored.select(F.col("id_b").alias("id_a"), F.col("id_a").alias("id_b"), "score"))
    with_self = both_ways.unionByName(names.select(F.col("id").alias("id_a"), F.col("id").alias("id_b"), F.lit(100.0).alias("score")))
    best = Window.partitionBy("id_a").orderBy(F.desc("score"), "id_b")
    listed = with_self.withColumn("place", F.row_number().over(best)).filter(
        (F.col("place") <= places) & (F.col("id_a") != F.col("id_b"))
    )
    left = names.select(F.col("id").alias("id_a"), F.col("name").alias("_a"), F.col("complaints").alias("_na"))
    right = names.select(F.col("id").alias("id_b"), F.col("name").alias("_b"), F.col("complaints").alias("_nb"))
    in_order = F.col("_a") < F.col("_b")
    named = listed.join(left, "id_a").join(right, "id_b").select(
        F.least("_a", "_b").alias("name_a"),
        F.greatest("_a", "_b").alias("name_b"),
        "score",
        F.when(in_order, F.col("_na")).otherwise(F.col("_nb")).alias("complaints_a"),
        F.when(in_order, F.col("_nb")).otherwise(F.col("_na")).alias("complaints_b"),
    )
    return (
        named.groupBy("name_a", "name_b", "complaints_a", "complaints_b")
        .agg(F.max("score").alias("_score"))
        .orderBy(F.desc("_score"), "name_a", "name_b")
        .select(
            "name_a", "name_b", F.bround("_score", 0).cast("bigint").alias("score"), "complaints_a", "complaints_b",
            F.lit("").alias("decision"),
        )
    )
