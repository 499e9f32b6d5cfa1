"""Broadcast only what has been counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows shipped to every task at most: narrow rows (keys, numbers, offsets) and
# rows that carry whole documents.
MAX_NARROW_ROWS = 1_000_000
MAX_DOCUMENT_ROWS = 20_000


def shipped(df: DataFrame, n_rows: int, max_rows: int = MAX_NARROW_ROWS) -> DataFrame:
    """``df`` marked for broadcast while its counted size allows it; beyond that
    the join shuffles both sides and the adaptive planner splits skewed keys."""
    return F.broadcast(df) if n_rows <= max_rows else df
