"""Name -> query, name -> SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import asset_queries, event_queries, evidence_queries, formal_queries, review_queries, text_queries

MODULES = (text_queries, review_queries, event_queries, formal_queries, evidence_queries, asset_queries)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for m in MODULES for k, v in m.QUERIES.items()}
SQL: dict[str, str] = {k: v for m in MODULES for k, v in m.SQL.items()}
