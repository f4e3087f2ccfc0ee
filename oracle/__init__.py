"""DuckDB statements that state each query's result in plain relational form."""

from oracle.statements import oracle_sql

__all__ = ["oracle_sql"]
