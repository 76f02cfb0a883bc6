"""Aggregates, data guards and count reconciliation."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def group_sum(df: DataFrame, keys: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(out or value))


def has_data(df: DataFrame, value: str) -> Column:
    """Scalar condition: there is at least one non-null amount."""
    return df.agg((F.count(value) > 0).alias("present")).scalar()


def only_if(df: DataFrame, guard: Column) -> DataFrame:
    """All rows, or none, depending on a scalar condition evaluated inside the plan."""
    return df.where(guard)


def reconcile_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows read, rows written and whether they agree."""
    counted = before.agg(F.count("*").alias("rows_read"))
    written = after.agg(F.count("*").alias("rows_written")).scalar()
    return counted.withColumn("rows_written", written).withColumn("agree", F.expr("rows_read = rows_written"))


def reconciled_write(df: DataFrame, step: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], None]) -> dict:
    """Write ``step(df)`` and tell the rows read, the rows written and whether they agree.

    Both counts are observed while the rows pass in the one action of ``write``; no job counts
    again. ``step`` uses its argument once. Should a task of an earlier stage be repeated after a
    loss, its rows count again: a difference is a reason to look, not a proof.
    """
    read, written = Observation(), Observation()
    count = F.count(F.lit(1)).alias("rows")
    write(step(df.observe(read, count)).observe(written, count))
    rows_read, rows_written = read.get["rows"], written.get["rows"]
    return {"rows_read": rows_read, "rows_written": rows_written, "agree": rows_read == rows_written}
