"""The registered queries: each operator over the given tables, next to its DuckDB text."""

from caselake.catalog import (  # noqa: F401  (importing registers the queries)
    case_queries, check_queries, drills, layers, questions, source_queries, stars, text_queries,
)
from caselake.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
