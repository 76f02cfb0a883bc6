"""Choosing among load and snapshot partitions: by folder names, or by rows of a DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.folders import NO_VALUE, partition_folders


def snapshot_key(column: Column) -> Column:
    """Partition value, or its second part where it is written ``first-second``."""
    text = column.cast("string")
    return F.when(F.contains(text, F.lit("-")), F.split_part(text, F.lit("-"), F.lit(2))).otherwise(text)


def snapshot_rows(df: DataFrame, partition_column: str, wanted: str) -> DataFrame:
    """Rows of the greatest partition whose key is ``wanted``; all rows if there is none.

    The choice is a scalar subquery over the partition column alone, evaluated before the scan, so
    the main scan still prunes its partitions.
    """
    part = F.col(partition_column)
    matching = df.where(snapshot_key(part) == wanted)
    best = matching.agg(F.max(part.cast("string"))).scalar()
    return df.where(best.isNull() | (part.cast("string") == best))


def _second_part(value: str) -> str:
    return value.split("-")[1] if "-" in value else value


def read_snapshot(spark: SparkSession, path: str, partition_column: str, wanted: str) -> DataFrame:
    """The greatest snapshot whose key is ``wanted``; all rows if there is none.

    The choice takes folder names alone, also those below plain folders, the greatest path first.
    Folders that cannot be listed are passed over with a warning.
    """
    folders = partition_folders(spark, path, partition_column)
    matching = [f for f in folders if _second_part(f.value) == wanted]
    if matching:
        best = max(matching, key=lambda f: f.path)
        return spark.read.option("basePath", best.parent).parquet(best.path)
    by_parent: dict[str, list[str]] = {}
    for folder in folders:
        by_parent.setdefault(folder.parent, []).append(folder.path)
    if not by_parent:
        return spark.read.parquet(path)
    tables = [spark.read.option("basePath", parent).parquet(*paths) for parent, paths in by_parent.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def read_latest(spark: SparkSession, path: str, partition_column: str) -> DataFrame:
    """The rows of the greatest partition by folder names: as numbers if all are, else as text."""
    df = spark.read.parquet(path)
    values = [f.value for f in partition_folders(spark, path, partition_column) if f.value != NO_VALUE]
    if not values:
        return df.limit(0)
    numbers = all(v.lstrip("-").isdigit() for v in values)
    return df.where(F.col(partition_column) == F.lit(max(values, key=int if numbers else str)))


def latest_partition(df: DataFrame, partition_column: str) -> DataFrame:
    """Rows of the greatest value of a partition column."""
    return df.where(F.col(partition_column) == df.agg(F.max(partition_column)).scalar())


def latest_load(df: DataFrame, partition_column: str, value_column: str, minimum) -> DataFrame:
    """Rows of the latest load with a value of at least ``minimum``."""
    return latest_partition(df, partition_column).where(F.col(value_column) >= F.lit(minimum))
