"""The KPI fact as wide metrics, one row per period and scenario."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import dictionary_projection
from ledgerloom.functions.scalars import strip_pattern
from ledgerloom.operators.reshape import pivot_sum


def build_wide(
    fact: DataFrame,
    dimension: DataFrame,
    labels: Mapping[str, str],
    costs: DataFrame | None = None,
    noise: str | None = None,
) -> DataFrame:
    """Fact amounts summed per label as named metrics, with the cost block beside them.

    ``labels`` maps each wanted label to its metric; ``noise`` is a pattern removed from the labels
    of the dimension first. Amounts are summed per key id before they meet the dimension, so no
    more than one row per period, scenario and id takes part in the join, whatever ids are hot.
    ``costs`` holds one row per period and scenario.
    """
    rows = fact.dropDuplicates([c for c in fact.columns if c != "record_id"])
    summed = rows.groupBy("period", "scenario_id", "kpi_id").agg(F.sum("value").alias("value"))
    return _named(summed, "kpi_id", dimension, labels, costs, noise)


def build_wide_of_keys(
    amounts: DataFrame,
    dimension: DataFrame,
    labels: Mapping[str, str],
    costs: DataFrame | None = None,
    noise: str | None = None,
) -> DataFrame:
    """What ``build_wide`` gives, from the distinct business keys (``keyed_amounts``) in place of the fact.

    A dimension gives each of its labels an id of its own, so amounts can be summed per full label;
    labels that it lacks take no part, like the fact's null ids.
    """
    summed = amounts.groupBy("period", "scenario_id", "kpi_label").agg(F.sum("value").alias("value"))
    return _named(summed, "kpi_label", dimension, labels, costs, noise)


def _named(
    summed: DataFrame, key: str, dimension: DataFrame, labels: Mapping[str, str], costs: DataFrame | None, noise: str | None
) -> DataFrame:
    label = F.col("kpi_label") if noise is None else strip_pattern("kpi_label", noise)
    labelled = summed.join(dimension.select(key, label.alias("label")), key)
    keys = ["period", "scenario_id"]
    wide = dictionary_projection(pivot_sum(labelled, keys, "label", "value", list(labels)), keys, labels)
    return wide if costs is None else wide.join(costs, keys, "left")
