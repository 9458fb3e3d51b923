"""Registered queries and, where SQL can say the same, their reference SQL."""

from tidemark.catalog import dimensions, landing, log, parity, registry, runs, silver  # noqa: F401
from tidemark.catalog.base import QUERIES, REFERENCE_SQL

__all__ = ["QUERIES", "REFERENCE_SQL"]
