"""All queries of the subpackage."""

from caselake.llm import (  # noqa: F401  (importing registers the queries)
    chat, decontamination, jaccard, lmscore, mixing, prefix_trie, quality, runs, suffix_dedup, surrogates, token_counts, toxicity, vptree,
)
from caselake.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
