"""Registered queries over the given tables, each with its check in SQL."""

from velotrail.queries import cells, changes, lines, reads, streams  # noqa: F401
from velotrail.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
