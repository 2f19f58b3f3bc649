"""The queries of this subpackage: ``QUERIES`` by name, and ``ORACLES`` where SQL can express the result."""

from __future__ import annotations

from tablefit.llm import native_queries, search_queries, text_queries

_PARTS = (native_queries, text_queries, search_queries)
QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
