from .oracle import oracle_sql
from .registry import flagship, queries

__all__ = ["queries", "oracle_sql", "flagship"]
