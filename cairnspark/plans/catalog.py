"""Registered queries and their SQL."""

from cairnspark.plans import demo, governance, ingest, sources  # noqa: F401  registers the queries
from cairnspark.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
