"""Queries over the given tables; importing this fills the registry."""

from millrace.plans import checks, decoding, networks, ordered_rows, over_time, streams, tables, timed_streams
from millrace.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "checks", "decoding", "networks", "ordered_rows", "over_time", "streams", "tables", "timed_streams"]
