"""All registered queries."""

from __future__ import annotations

from assaymill.plans import expression_queries, mapping_queries, more_queries, source_queries, table_queries, text_queries  # noqa: F401
from assaymill.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
