"""The registered queries and their oracles."""

from __future__ import annotations

from . import kernel_queries, mesh_queries, record_queries

QUERIES = mesh_queries.QUERIES | record_queries.QUERIES | kernel_queries.QUERIES
ORACLE_SQL = mesh_queries.ORACLE_SQL | record_queries.ORACLE_SQL | kernel_queries.ORACLE_SQL
