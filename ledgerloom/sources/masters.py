"""Master data and catalogue tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ledgerloom.functions.columns import typed_projection
from ledgerloom.functions.scalars import iso_to_blank


def load_master(df: DataFrame, spec: list[tuple[str, str, DataType | str]], stamp: str, stamp_name: str) -> DataFrame:
    """Typed and renamed master data plus its load stamp as plain text."""
    typed = typed_projection(df, [*spec, (stamp, stamp_name, "string")])
    return typed.withColumn(stamp_name, iso_to_blank(stamp_name))


def flatten_catalogue(catalogue: DataFrame) -> DataFrame:
    """``(workspace, reports array<struct<name, dataset_id>>)`` to one row per report."""
    return catalogue.select("workspace", F.inline("reports").alias("report", "dataset"))


def catalogue_measures(catalogue: DataFrame, measures: DataFrame) -> DataFrame:
    """Measures of each listed report, looked up by its dataset."""
    return flatten_catalogue(catalogue).join(measures, "dataset", "left")
