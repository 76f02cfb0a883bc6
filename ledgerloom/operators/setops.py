"""Unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_positional(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by position, written as a union by name after the columns have been aligned."""
    return reduce(lambda a, b: a.unionByName(b.toDF(*a.columns)), others, first)


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by name; columns missing on one side are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, first)


def union_distinct(first: DataFrame, *others: DataFrame) -> DataFrame:
    return union_by_name(first, *others).distinct()
