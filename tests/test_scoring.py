import re

from caselake.functions import scoring as SC
from caselake.sources.relations import inline_relation

SALES = "Carry a quota. OTE $250k. Partner with Account Executives on demos."
ENGINEERING = "Build and deploy production RAG systems in Python on Kubernetes, end-to-end."


def score(spark, description, reports_to="", comp_text=""):
    row = (1, description, reports_to, comp_text)
    df = inline_relation(spark, [row], "id INT, description STRING, reports_to STRING, comp_text STRING")
    return SC.score_postings(df).first()


def test_sales_role(spark):
    assert score(spark, SALES)["label"] == "SALES-DISGUISED"


def test_engineering_role(spark):
    found = score(spark, ENGINEERING, "Head of Forward Deployed Engineering")
    assert found["label"] == "engineering" and found["evidence"].endswith("reports_to_eng:+4")


def test_points_follow_the_patterns(spark):
    for text in [SALES, ENGINEERING, "quota " * 9, "vote note ote", "éproduction production", None]:
        total, hits = 0, []
        seen = f"{text or ''} "
        for s in SC.POSTING_SIGNALS:
            n = len(re.findall(s.pattern, seen, 0 if s.case_sensitive else re.IGNORECASE))
            if n:
                total += s.weight * min(n, 3)
                hits.append(f"{s.pattern}:{s.weight * min(n, 3):+d}")
        found = score(spark, text)
        assert (found["score"], found["evidence"]) == (total, "; ".join(hits))


def test_only_one_context_counts(spark):
    assert score(spark, "", "Sales Engineering")["score"] == -6
    assert score(spark, "", None)["score"] == 0
