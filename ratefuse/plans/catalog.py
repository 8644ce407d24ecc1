"""All registered queries."""

from ratefuse.plans import (  # noqa: F401
    queries_check, queries_compare, queries_fields, queries_fuse,
)
from ratefuse.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
