"""Pivots with explicit values, unpivots and tagged unpivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ledgerloom.functions.types import MONEY

NULL_LABEL = "null"


def pivot_sum(
    df: DataFrame, keys: Sequence[str], label: str, value: str, labels: Sequence[str], dtype: DataType = MONEY
) -> DataFrame:
    """Sum per label as columns. The labels are given, so no job lists them and the schema is fixed.

    A null label is summed into the column ``null`` if that name is among the labels. Spark sums
    per (keys, label) before it turns labels into columns.
    """
    source = df.withColumn(label, F.coalesce(F.col(label), F.lit(NULL_LABEL))) if NULL_LABEL in labels else df
    wide = source.groupBy(*keys).pivot(label, list(labels)).agg(F.sum(value))
    return wide.select(*keys, *[F.col(f"`{v}`").cast(dtype).alias(v) for v in labels])


def unpivot_metrics(
    df: DataFrame, keys: Sequence[str], metrics: Sequence[str], name: str = "metric", value: str = "amount"
) -> DataFrame:
    """Wide metrics to rows; null amounts are dropped."""
    return df.unpivot(list(keys), list(metrics), name, value).where(F.col(value).isNotNull())


def unpivot_tagged(
    df: DataFrame, keys: Sequence[str], metrics: Sequence[str], mapping: DataFrame, on: Sequence[str] = ("metric",)
) -> DataFrame:
    """Metrics to rows carrying the tags of a mapping table; one metric may feed several rows."""
    return unpivot_metrics(df, keys, metrics).join(mapping, list(on), "inner")


def unpivot_pair(
    df: DataFrame, keep: Sequence[str], pairs: Sequence[tuple[str, int]], code: str, value: str
) -> DataFrame:
    """Each row once per (column, code) pair, in one pass over the data."""
    items = [F.struct(F.lit(c).alias(code), F.col(name).alias(value)) for name, c in pairs]
    return df.select(*keep, F.inline(F.array(*items)).alias(code, value))


def transpose(df: DataFrame, fixed: Sequence[str], transposed: Sequence[str], dtype: str = "double") -> DataFrame:
    """Attributes as rows (attribute, value); nulls are kept."""
    typed = df.select(*fixed, *[F.col(c).cast(dtype).alias(c) for c in transposed])
    return typed.unpivot(list(fixed), list(transposed), "attribute", "value")


def pivot_back(
    df: DataFrame, fixed: Sequence[str], attributes: Sequence[str], attribute: str = "attribute", value: str = "value"
) -> DataFrame:
    """One row per combination of the fixed columns, one column per attribute."""
    wide = df.groupBy(*fixed).pivot(attribute, list(attributes)).agg(F.first(value, ignorenulls=True))
    return wide.select(*fixed, *attributes)
