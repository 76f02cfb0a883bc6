"""Sinks: partition overwrite, slice replacement, append, stage boundaries, JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.sources.folders import partition_folders, remove_folder
from ledgerloom.sources.tables import read_slice

# Writer settings for the warehouse tables.
JDBC_BATCH_SIZE = 1_000_000
JDBC_ISOLATION = "READ_UNCOMMITTED"
JDBC_CONNECTIONS = 16


def _placed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring equal partition keys together; the rebalance hint lets Spark split a hot key."""
    return df.hint("rebalance", *keys)


def overwrite_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``."""
    writer = _placed(df, keys).write.partitionBy(*keys).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def append_rows(df: DataFrame, path: str, keys: Sequence[str] = ()) -> None:
    writer = (_placed(df, keys) if keys else df).write.mode("append")
    (writer.partitionBy(*keys) if keys else writer).parquet(path)


def overwrite_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def replace_slice(
    df: DataFrame, path: str, period_column: str, period: int, scenario_column: str, scenarios: Sequence[int] | None
) -> None:
    """Make the slice (period, scenarios) of the table at ``path`` equal to the rows of ``df``.

    The table is laid out by period and scenario. ``scenarios=None`` replaces the whole period. A row
    outside the slice is an error. ``df`` is evaluated once, and all its leaf folders are replaced
    by one commit: what fails before it leaves the old slice whole. Then the leaves for which
    ``df`` has no rows are removed; should that fail, the run is repeated. A table whose last leaf
    goes has no files, so that its readers need its schema.
    """
    spark = df.sparkSession
    inside = F.col(period_column) == period
    if scenarios is not None:
        inside = inside & F.col(scenario_column).isin(list(scenarios))
    checked = F.when(F.coalesce(inside, F.lit(False)), F.col(scenario_column)).otherwise(
        F.raise_error(F.lit(f"a row lies outside the slice {period_column}={period}, {scenarios}"))
    )
    written = Observation()
    rows = df.withColumn(scenario_column, checked).observe(written, F.collect_set(F.col(scenario_column).cast("string")).alias("scenarios"))
    placed = _placed(rows, [scenario_column]).write.partitionBy(period_column, scenario_column).mode("overwrite")
    placed.option("partitionOverwriteMode", "dynamic").parquet(path)
    present = set(written.get["scenarios"])
    for leaf in partition_folders(spark, f"{path}/{period_column}={period}", scenario_column):
        listed = scenarios is None or leaf.value in {str(s) for s in scenarios}
        if listed and leaf.value not in present:
            remove_folder(spark, leaf.path)


def stage_boundary(df: DataFrame, path: str, keys: Sequence[str], wanted: Mapping[str, object]) -> DataFrame:
    """Write by partition, then read the wanted slice back: later steps start from stored rows."""
    overwrite_partitions(df, path, keys)
    return read_slice(df.sparkSession, path, wanted)


def jdbc_options(url: str, table: str, truncate: bool, partitions: int, **extra: str) -> dict[str, str]:
    """Writer options for a warehouse table; ``truncate`` keeps its definition on overwrite."""
    return {
        "url": url,
        "dbtable": table,
        "truncate": str(truncate).lower(),
        "batchsize": str(JDBC_BATCH_SIZE),
        "isolationLevel": JDBC_ISOLATION,
        "numPartitions": str(partitions),
        **extra,
    }


def write_jdbc(df: DataFrame, url: str, table: str, mode: str, partitions: int = JDBC_CONNECTIONS, **extra: str) -> None:
    """Overwrite (truncating) or append a warehouse table over at most ``partitions`` connections."""
    options = jdbc_options(url, table, mode == "overwrite", partitions, **extra)
    df.write.format("jdbc").options(**options).mode(mode).save()
