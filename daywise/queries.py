"""All registered queries and their SQL twins."""

from .bindings import daily_queries, row_queries, source_queries  # noqa: F401  (register)
from .bindings.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
