"""All registered queries."""

from kindred.plans import scans, store_queries, stream_queries, text_queries, vector_queries  # noqa: F401
from kindred.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
