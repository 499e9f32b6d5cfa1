"""Predicates and projections on a nested ``array<struct>`` column.

All are higher-order functions on the row itself: no explode, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from kindred.functions.text import tokens

Condition = Callable[[Column], Column]


def score_at_least(minimum: float, field: str = "score") -> Condition:
    return lambda child: child[field] >= F.lit(minimum)


def mentions(query: str | Column, field: str = "keyword") -> Condition:
    """The child's text has at least one token of ``query``."""
    wanted = tokens(F.lit(query) if isinstance(query, str) else query)
    return lambda child: F.arrays_overlap(tokens(child[field]), wanted)


def equals(value: str, field: str = "keyword") -> Condition:
    """Exact match on the untouched string."""
    return lambda child: child[field] == F.lit(value)


def any_child(children: Column, *conditions: Condition) -> Column:
    """True where ONE child meets all conditions together."""

    def all_of(child: Column) -> Column:
        met = conditions[0](child)
        for condition in conditions[1:]:
            met = met & condition(child)
        return met

    return F.exists(children, all_of)


def matching_children(children: Column, *conditions: Condition, size: int = 3) -> Column:
    """The first ``size`` children that meet all conditions, in stored order."""

    def all_of(child: Column) -> Column:
        met = conditions[0](child)
        for condition in conditions[1:]:
            met = met & condition(child)
        return met

    return F.slice(F.filter(children, all_of), 1, size)


def preview(children: Column, shown: int = 5) -> tuple[Column, Column]:
    """(first ``shown`` children, how many more there are)."""
    return F.slice(children, 1, shown), F.greatest(F.size(children) - shown, F.lit(0))
