"""All named queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textmill.plans import corpus, enriched, items, records, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for _module in (corpus, records, vectors, items, enriched):
    QUERIES |= _module.QUERIES
    ORACLE_SQL |= _module.ORACLE_SQL
