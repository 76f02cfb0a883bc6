"""Row numbers over a global or per-group order without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.joins import join_keys_null_safe
from ledgerloom.session import stage_rows

_LOCAL_BITS = 33  # layout of monotonically_increasing_id: partition id above, row below


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    out: str,
    partition_by: Sequence[str] = (),
    start: Column | int = 0,
    dtype: str = "bigint",
) -> DataFrame:
    """``row_number() over (partition by .. order by ..) + start``.

    Rows are range-partitioned and sorted, numbered inside their partition and shifted by the number
    of their group's rows in the partitions before. The placed rows are stored first, because
    partition boundaries come from sampling and must be the same for the counts and for the numbers;
    the counts then read two or three columns of the stage. Include enough columns in the order to
    tell rows apart: then the numbers are reproducible and a hot value spreads over many partitions.
    """
    order = [*partition_by, *order_by]
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.withColumn("__position", F.monotonically_increasing_id())
    placed = stage_rows(placed.withColumn("__chunk", F.shiftright("__position", _LOCAL_BITS)), "numbered")
    keys = ["__chunk", *partition_by]
    counts = placed.groupBy(*keys).agg(F.count("*").alias("__size"), F.min("__position").alias("__first"))
    # A group has one row per shuffle partition here, whatever the size of the data.
    before = Window.partitionBy(*partition_by).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("__size").over(before), F.lit(0)) - F.col("__first") + 1
    shifts = counts.select(*keys, shift.alias("__shift"))
    base = F.lit(start) if isinstance(start, int) else start
    number = (F.col("__position") + F.col("__shift") + base).cast(dtype)
    return join_keys_null_safe(placed, shifts, keys).select(*df.columns, number.alias(out))
