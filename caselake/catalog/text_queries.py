"""Keyword scores over whole documents, and company-name candidates."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselake.catalog.layers import WITH_SILVER, silver_table
from caselake.catalog.registry import query
from caselake.catalog.standin import sql_text, table
from caselake.functions import scoring as SC
from caselake.operators.similarity import company_candidates
from caselake.plans import gold as G
from caselake.session import materialise, scratch_path
from caselake.sources.files import export_csv, read_raw_csv

# Words that do occur in the documents, in the shape of the posting signals.
DOCUMENT_SIGNALS = [
    SC.Signal(r"\b(the|of)\b", 2),
    SC.Signal(r"\bthe[- ]on\b", 3),
    SC.Signal(r"\b(un|une|le)s?\b", -2),
    SC.Signal(r"\bThe\b", 1, case_sensitive=True),
    SC.Signal(r"\b(der|und|die)\b", -3),
    SC.Signal(r"\blicen[sc]es?\b", 4),
    SC.Signal(r"\b(copyright|email)\b", -1),
    SC.Signal(r"\ben\b", -1),
]
CONTEXT = [("first_sources", r"\bsrc[0-4]\b", -6), ("later_sources", r"\bsrc1\d\b", 4)]


def _score_sql(signals, context_rules, text: str, context: str | None) -> str:
    """Points per signal as a list of (name, points), for DuckDB.

    Its word boundary only knows ASCII: other letters become 'x', other signs '.', so that both
    engines see the same word ends.
    """
    ascii_text = (
        rf"regexp_replace(regexp_replace({text}, '[^\x00-\x7F\p{{L}}\p{{N}}\p{{M}}]', '.', 'g'), '[^\x00-\x7F]', 'x', 'g')"
    )
    parts = []
    for s in signals:
        pattern = ("" if s.case_sensitive else "(?i)") + s.pattern
        points = f"least(length(regexp_extract_all(t, {sql_text(pattern)})), {SC.REPEAT_CAP}) * {s.weight}"
        parts.append(f"{{'name': {sql_text(s.pattern)}, 'points': {points}}}")
    if context:
        names = " ".join(f"WHEN regexp_matches(c, {sql_text('(?i)' + p)}) THEN {sql_text(n)}" for n, p, _ in context_rules)
        values = " ".join(f"WHEN regexp_matches(c, {sql_text('(?i)' + p)}) THEN {v}" for _, p, v in context_rules)
        parts.append(f"{{'name': CASE {names} ELSE '' END, 'points': CASE {values} ELSE 0 END}}")
    return f"""WITH seen AS (SELECT *, {ascii_text} AS t, {context or "''"} AS c FROM documents),
scored AS (SELECT *, [{', '.join(parts)}] AS signals FROM seen),
summed AS (SELECT doc_id, CAST(list_sum([s.points for s in signals]) AS BIGINT) AS score,
  array_to_string([s.name || ':' || if(s.points > 0, '+', '') || s.points for s in signals if s.points <> 0], '; ') AS evidence
  FROM scored)
SELECT *, CASE WHEN score >= 8 THEN 'engineering' WHEN score <= -3 THEN 'SALES-DISGUISED' ELSE 'mixed - read carefully' END AS label
FROM summed"""


# phrases of postings, one per signal and some without any; a document gets a few, some more than the cap
PHRASES = [
    "runs in production", "builds services", "end-to-end work", "Python and SQL", "Docker on AWS", "LLM agents", "dbt", "a quota",
    "OTE", "ote", "commission", "presales", "close deals", "account executives", "demos", "RFPs", "team lunch",
]
LEADERS = ["Sales Director", "VP of Engineering", "the CTO and the head of sales", "nobody"]
POSTING_SQL = " || ' ' || ".join(
    ["coalesce(text, '')"]
    + [f"repeat([{', '.join(map(sql_text, PHRASES))}][(doc_id * {m}) % {len(PHRASES)} + 1] || ' ', CAST(doc_id % {n} AS BIGINT))" for m, n in ((1, 6), (5, 3), (11, 2))]
)
LEADER_SQL = f"[{', '.join(map(sql_text, LEADERS))}][doc_id % {len(LEADERS)} + 1]"


def postings(spark, sf):
    """The documents in the layout of job postings, with phrases and leaders chosen by doc_id."""
    pick = lambda words, i: F.element_at(F.array(*map(F.lit, words)), (i % len(words) + 1).cast("int"))
    said = [F.repeat(F.concat(pick(PHRASES, F.col("doc_id") * m), F.lit(" ")), (F.col("doc_id") % n).cast("int")) for m, n in ((1, 6), (5, 3), (11, 2))]
    text = F.concat_ws(" ", F.coalesce("text", F.lit("")), *said)
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), text.alias("description"), pick(LEADERS, F.col("doc_id")).alias("reports_to"), F.lit("").alias("comp_text")
    )


def scored_documents(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text", "source")
    scored = SC.score_text(documents, "text", "source", DOCUMENT_SIGNALS, CONTEXT)
    return scored.select("doc_id", "score", "evidence", SC.score_label("score").alias("label"))


@query("m1_score_documents", _score_sql(DOCUMENT_SIGNALS, CONTEXT, "text", "source"))
def _(spark, sf):
    return SC.best_first(scored_documents(spark, sf), "doc_id")


@query("m2_score_postings", _score_sql(SC.POSTING_SIGNALS, SC.POSTING_CONTEXT, f"{POSTING_SQL} || ' '", LEADER_SQL))
def _(spark, sf):
    return SC.score_postings(postings(spark, sf)).select(F.col("id").alias("doc_id"), "score", "evidence", "label")


@query("m3_scored_csv", _score_sql(DOCUMENT_SIGNALS, CONTEXT, "text", "source").replace(
    "SELECT *, CASE WHEN", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(score AS VARCHAR) AS score, nullif(evidence, '') AS evidence, CASE WHEN"
))
def _(spark, sf):
    # the labelled list written as CSV and read back
    path = scratch_path(spark, "scored_csv")
    export_csv(scored_documents(spark, sf), path)
    return read_raw_csv(spark, path)


# all pairs by definition; the longest common subsequence keeps one bit per letter of the first rest in a number
CANDIDATES_SQL = r"""
topmost AS (SELECT row_number() OVER (ORDER BY complaints DESC, company) AS id, company AS name, complaints
  FROM (SELECT company, count(*) AS complaints FROM silver WHERE company IS NOT NULL GROUP BY company)
  QUALIFY id <= 300),
tokens AS (SELECT *, list_sort(list_distinct(list_filter(string_split_regex(name, '\s+'), lambda w: w <> ''))) AS words FROM topmost),
pairs AS (SELECT a.id AS id_a, b.id AS id_b, array_to_string(list_filter(a.words, lambda w: list_contains(b.words, w)), ' ') AS shared,
    array_to_string(list_filter(a.words, lambda w: NOT list_contains(b.words, w)), ' ') AS rest_a,
    array_to_string(list_filter(b.words, lambda w: NOT list_contains(a.words, w)), ' ') AS rest_b
  FROM tokens a JOIN tokens b ON a.id < b.id AND len(a.words) > 0 AND len(b.words) > 0),
bits AS (SELECT *, if(rest_a = '', [], string_split(rest_a, '')) AS letters, (1::HUGEINT << length(rest_a)) - 1 AS every,
    if(shared = '', 0, 1) AS gap FROM pairs),
masks AS (SELECT *, list_transform(if(rest_b = '', [], string_split(rest_b, '')), lambda c: coalesce(list_sum(
    list_transform(letters, lambda x, i: if(x = c, 1::HUGEINT << (i - 1), 0::HUGEINT))), 0)::HUGEINT) AS found FROM bits),
common AS (SELECT *, length(rest_a) - bit_count(list_reduce(found, lambda s, m: ((s + (s & m)) | (s - (s & m))) & every, every)) AS same,
    length(shared) + gap + length(rest_a) AS full_a, length(shared) + gap + length(rest_b) AS full_b FROM masks),
rated AS (SELECT id_a, id_b, CASE WHEN shared <> '' AND (rest_a = '' OR rest_b = '') THEN 100.0::DOUBLE ELSE greatest(
    100.0::DOUBLE - 100.0::DOUBLE * (length(rest_a) + length(rest_b) - 2 * same) / (full_a + full_b),
    if(shared = '', 0, 100.0::DOUBLE - 100.0::DOUBLE * (gap + length(rest_a)) / (length(shared) + full_a)),
    if(shared = '', 0, 100.0::DOUBLE - 100.0::DOUBLE * (gap + length(rest_b)) / (length(shared) + full_b))) END AS score FROM common),
listed AS (SELECT id_a, id_b, score FROM (
    SELECT id_a, id_b, score FROM rated WHERE score >= 88 UNION ALL SELECT id_b, id_a, score FROM rated WHERE score >= 88
    UNION ALL SELECT id, id, 100.0 FROM topmost)
  QUALIFY row_number() OVER (PARTITION BY id_a ORDER BY score DESC, id_b) <= 6)
SELECT least(a.name, b.name) AS name_a, greatest(a.name, b.name) AS name_b, CAST(round_even(max(score), 0) AS BIGINT) AS score,
  if(a.name < b.name, a.complaints, b.complaints) AS complaints_a, if(a.name < b.name, b.complaints, a.complaints) AS complaints_b, '' AS decision
FROM listed JOIN topmost a ON a.id = id_a JOIN topmost b ON b.id = id_b WHERE id_a <> id_b GROUP BY ALL"""


@query("j10_company_candidates", f"{WITH_SILVER},{CANDIDATES_SQL}")
def _(spark, sf):
    scorecard = materialise(G.company_scorecard(silver_table(spark, sf)), "company_scorecard")
    return company_candidates(scorecard)
