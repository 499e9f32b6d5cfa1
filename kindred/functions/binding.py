"""Evaluate an expression once where a lambda looks into it many times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` bound to a lambda variable. Without it an
    expression used inside ``transform`` is computed again for every element."""
    return F.get(F.transform(F.array(value), body), 0)
