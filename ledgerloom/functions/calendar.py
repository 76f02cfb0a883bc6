"""Integer period codes: ``yyyymm`` (month) and ``yyyymmdd`` (day)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_code(timestamp: Column) -> Column:
    return (F.year(timestamp) * 100 + F.month(timestamp)).cast("int")


def first_day(period: Column) -> Column:
    """``yyyymm -> yyyymm01``."""
    return (period * 100 + 1).cast("int")


def year_of_day(day_code: Column) -> Column:
    return F.floor(day_code / 10000).cast("int")


def year_of_month(period: Column) -> Column:
    return F.floor(period / 100).cast("int")


def is_january(period: Column) -> Column:
    return period % 100 == 1


def year_start(day_code: int) -> int:
    """First day code of the year of a literal day code."""
    return day_code // 10000 * 10000 + 101


def year_floor(day_code: int) -> int:
    """``yyyy0000``, below every day code of the year."""
    return day_code // 10000 * 10000
