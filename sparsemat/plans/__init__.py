"""Matrix queries over the star-schema test tables, with their SQL counterparts."""

from .catalog import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
