"""Values that a column expression names once and uses often."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, not once per use or per step of a fold."""
    return F.get(F.transform(F.array(value), body), 0)
