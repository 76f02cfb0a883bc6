"""Predicates that keep the raw column on one side, so that they reach the scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_equal(values: Mapping[str, object]) -> Column:
    """``a = x and b = y ..``; a sequence stands for an IN list."""
    result = F.lit(True)
    for name, value in values.items():
        column = F.col(name)
        if isinstance(value, (list, tuple, set)):
            result = result & column.isin(list(value))
        else:
            result = result & (column == F.lit(value))
    return result


def any_of(groups: Sequence[Mapping[str, object]]) -> Column:
    """OR over groups of AND-ed equalities."""
    result = F.lit(False)
    for group in groups:
        result = result | all_equal(group)
    return result


def within(column: str, low: int, high: int, open_end: bool = False) -> Column:
    c = F.col(column)
    return (c >= low) & ((c < high) if open_end else (c <= high))


def same_year(column: str, day_code: int) -> Column:
    """Day code lies in the year of a literal day code; a plain range, hence prunable."""
    year = day_code // 10000
    return F.col(column).between(year * 10000, year * 10000 + 9999)
