"""All registered queries of the subpackage."""

from kindred.llm import queries  # noqa: F401
from kindred.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
