"""Weighted keyword scores with evidence and labels (M1-M3)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.functions.columns import as_column
from caselake.session import materialise


class Signal(NamedTuple):
    pattern: str
    weight: int
    case_sensitive: bool = False


# Job-posting signals. Positive points to engineering, negative to sales.
POSTING_SIGNALS = [
    Signal(r"\bproduction\b", 3),
    Signal(r"\b(build|ship|deploy)(s|ing)?\b", 2),
    Signal(r"\bend[- ]to[- ]end\b", 2),
    Signal(r"\b(python|sql|typescript|go|java)\b", 1),
    Signal(r"\b(kubernetes|docker|terraform|aws|gcp|azure)\b", 1),
    Signal(r"\b(rag|llms?|agents?|evals?|mcp)\b", 1),
    Signal(r"\b(data pipelines?|etl|dbt)\b", 1),
    Signal(r"\bquota\b", -5),
    Signal(r"\bOTE\b", -5, case_sensitive=True),
    Signal(r"\bcommission\b", -4),
    Signal(r"\b(pre-?sales)\b", -4),
    Signal(r"\b(close deals?|drive revenue|pipeline generation)\b", -3),
    Signal(r"\baccount executives?\b", -2),
    Signal(r"\b(demos?|presentations?)\b", -1),
    Signal(r"\b(rfp|rfi)s?\b", -2),
]
# Context of the posting; the first pattern found wins.
POSTING_CONTEXT = [
    ("reports_to_sales", r"\b(sales|revenue|go[- ]to[- ]market|gtm)\b", -6),
    ("reports_to_eng", r"\b(engineering|cto|forward deployed)\b", 4),
]
# Label thresholds.
ENGINEERING_FROM, SALES_UP_TO, REPEAT_CAP = 8, -3, 3


def _regex(signal: Signal) -> Column:
    # U: word boundaries and case follow Unicode, as the patterns expect
    return F.lit(("(?U)" if signal.case_sensitive else "(?iU)") + signal.pattern)


def signal_points(text: Column | str, signal: Signal, cap: int = REPEAT_CAP) -> Column:
    """weight * min(matches, cap) for one signal."""
    hits = F.least(F.regexp_count(as_column(text), _regex(signal)), F.lit(cap))
    return F.coalesce(hits, F.lit(0)) * F.lit(signal.weight)


def context_points(context: Column | str, rules=POSTING_CONTEXT) -> Column:
    """Points of the first context rule that matches, else 0."""
    context, chain = F.coalesce(as_column(context), F.lit("")), F
    for _, pattern, points in rules:
        chain = chain.when(context.rlike("(?iU)" + pattern), F.lit(points))
    return chain.otherwise(0)


def _evidence(name: str, points: Column) -> Column:
    # concat_ws skips the NULLs of signals that gave nothing
    return F.when(
        points != 0,
        F.concat(F.lit(name + ":"), F.when(points > 0, F.lit("+")).otherwise(F.lit("")), points.cast("string")),
    )


def score_text(
    df: DataFrame,
    text: Column | str,
    context: Column | str | None = None,
    signals: Sequence[Signal] = POSTING_SIGNALS,
    rules=POSTING_CONTEXT,
) -> DataFrame:
    """Add ``score`` and ``evidence``. Every pattern is matched once per text: the points are
    computed into one array first, and both results read that array."""
    parts = [signal_points("_text", s) for s in signals]
    names = [s.pattern for s in signals]
    if context is not None:
        parts.append(context_points("_context", rules))
    scored = df.withColumn("_text", as_column(text))
    if context is not None:
        scored = scored.withColumn("_context", as_column(context))
    scored = scored.withColumn("_points", F.array(*parts))
    evidence = [_evidence(name, F.col("_points")[i]) for i, name in enumerate(names)]
    if context is not None:
        chain = F
        for name, pattern, points in rules:
            chain = chain.when(
                F.coalesce(F.col("_context"), F.lit("")).rlike("(?iU)" + pattern), F.lit(f"{name}:{points:+d}")
            )
        evidence.append(chain.otherwise(F.lit(None)))
    total = reduce(add, [F.col("_points")[i] for i in range(len(parts))])
    return scored.select(
        *[F.col(c) for c in df.columns],
        total.cast("bigint").alias("score"),
        F.concat_ws("; ", *evidence).alias("evidence"),
    )


def score_label(score: Column | str) -> Column:
    score = as_column(score)
    return (
        F.when(score >= ENGINEERING_FROM, "engineering")
        .when(score <= SALES_UP_TO, "SALES-DISGUISED")
        .otherwise("mixed - read carefully")
    )


def posting_text() -> Column:
    """Description and pay text of a posting, as one text."""
    return F.concat(
        F.coalesce(F.col("description"), F.lit("")), F.lit(" "), F.coalesce(F.col("comp_text"), F.lit(""))
    )


def score_postings(postings: DataFrame) -> DataFrame:
    """Scored and labelled postings, best first."""
    scored = score_text(postings, posting_text(), "reports_to")
    return best_first(scored.withColumn("label", score_label("score")), "id")


def best_first(scored: DataFrame, row_id: str) -> DataFrame:
    """Sorted by score. A global sort runs its input twice, once to find the ranges, so the scores are
    stored first and every pattern is matched once."""
    return materialise(scored, "scores").orderBy(F.desc("score"), row_id)
