"""DuckDB oracle SQL for the registered queries (tests and driver only)."""

from oracle.duckdb_sql import oracle_queries

__all__ = ["oracle_queries"]
