"""Operators for preparing training text: one module per operator, each with its query."""

from millrace.llm.plans import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
