"""Queries of the record-linkage operators, by name, and their SQL."""

from __future__ import annotations

from tessera.plans import pair_queries, record_queries
from tessera.plans.record_queries import flagship

QUERIES = record_queries.QUERIES | pair_queries.QUERIES
SQL = record_queries.SQL | pair_queries.SQL

__all__ = ["QUERIES", "SQL", "flagship"]
