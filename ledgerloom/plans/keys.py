"""Surrogate keys and the KPI dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.columns import all_nullable
from ledgerloom.operators.joins import anti_join_trimmed
from ledgerloom.operators.numbering import number_rows
from ledgerloom.session import new_path, stage_rows
from ledgerloom.sources.folders import make_folder, move_folder


def surrogate_key_delta(source: DataFrame, target: DataFrame, id_column: str, key: str) -> DataFrame:
    """Ids for the source keys that the target does not hold yet.

    New keys are numbered in key order from the greatest existing id on; an empty target makes the
    numbering start at 1. Keys compare trimmed.
    """
    highest = F.coalesce(target.agg(F.max(id_column)).scalar(), F.lit(0))
    fresh = anti_join_trimmed(source.select(key), target, key)
    return number_rows(fresh, [key], id_column, start=highest, dtype="int")


def extend_dimension(labels: DataFrame, dimension: DataFrame, id_column: str, key: str) -> DataFrame:
    """The dimension with the new labels added; facts of the same run must join this one."""
    fresh = labels.select(key).where(F.col(key).isNotNull()).distinct()
    delta = all_nullable(surrogate_key_delta(fresh, dimension, id_column, key))
    return dimension.select(id_column, key).unionByName(delta.select(id_column, key))


_TRIES = 20
_AFTER = "after_id"  # partition column of a stored dimension


def stored_dimension(spark: SparkSession, path: str, id_column: str, key: str) -> DataFrame:
    """The dimension stored at ``path``, without rows if there is none yet."""
    make_folder(spark, path)
    return spark.read.schema(f"{id_column} int, {key} string, {_AFTER} int").parquet(path).select(id_column, key)


def store_labels(labels: DataFrame, path: str, id_column: str, key: str) -> DataFrame:
    """Append the labels that the dimension stored at ``path`` lacks, and read it back.

    New ids follow the greatest stored one, whose number names the folder that is added. The folder is
    filled beside the table and moved in only if no other run has added one after the same id;
    else the delta is made anew from what that run has left. So two runs give a label one id, and a
    repeated run adds nothing.
    """
    spark = labels.sparkSession
    fresh = stage_rows(labels.select(key).where(F.col(key).isNotNull()).distinct(), "labels")
    for _ in range(_TRIES):
        known = stored_dimension(spark, path, id_column, key)
        highest = known.agg(F.coalesce(F.max(id_column), F.lit(0))).first()[0]
        delta = surrogate_key_delta(fresh, known, id_column, key)
        waiting = new_path(spark, "delta")
        delta.select(id_column, key).write.parquet(waiting)
        if spark.read.parquet(waiting).isEmpty() or move_folder(spark, waiting, f"{path}/{_AFTER}={highest}"):
            return stored_dimension(spark, path, id_column, key)
    raise RuntimeError(f"other runs added labels to {path} {_TRIES} times meanwhile")
