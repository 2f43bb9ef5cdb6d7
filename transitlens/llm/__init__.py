"""Training-data operators; nothing else in the library imports this package."""

from .registry import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
