"""Wide metrics to report rows, and the way back to their dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scenarios import SINGLE_PERIOD, STAGE_IDS, restage_scenario
from ledgerloom.functions.types import MONEY, PUBLISHED
from ledgerloom.operators.reshape import unpivot_tagged
from ledgerloom.plans.periods import LOCAL

# Columns of a mapping table: which metric feeds which report row.
MAPPING_SCHEMA = (
    "scenario_id int, metric string, report_id int, concept_id int, business_id string, dim1_id int, dim2_id int"
)

_MAPPING_COLUMNS = [part.split()[0] for part in MAPPING_SCHEMA.split(", ")]


def report_rows(
    wide: DataFrame, mapping: DataFrame, metrics: Sequence[str], rate_acc: str, rate_month: str
) -> DataFrame:
    """Report rows in the local currency for every scenario at once.

    ``wide`` has ``period_date``, the fact stage's ``scenario_id`` and the metrics. The mapping says
    per scenario and metric which rows to write; columns it has beyond ``MAPPING_SCHEMA``, such as
    a cost type, are passed on. The updated budget uses the monthly rate for both rates.
    """
    updated = F.col("scenario_id") == STAGE_IDS["fact"]["UPA"]
    rated = wide.select(
        "period_date",
        "scenario_id",
        F.when(updated, F.col(rate_month)).otherwise(F.col(rate_acc)).cast(MONEY).alias("__rate_acc"),
        F.col(rate_month).cast(MONEY).alias("__rate_month"),
        *[F.col(m).cast(MONEY).alias(m) for m in metrics],
    )
    keys = ["period_date", "scenario_id", "__rate_acc", "__rate_month"]
    rows = unpivot_tagged(rated, keys, metrics, mapping, on=("scenario_id", "metric"))
    return rows.select(
        "report_id",
        "concept_id",
        "business_id",
        F.lit(None).cast("int").alias("company_id"),
        F.lit(SINGLE_PERIOD).alias("data_type_id"),
        "dim1_id",
        "dim2_id",
        restage_scenario("scenario_id", "fact", "published").alias("scenario_id"),
        F.col("amount").cast(PUBLISHED).alias("amount"),
        F.col("__rate_acc").alias("rate_acc"),
        F.col("__rate_month").alias("rate_month"),
        F.lit(LOCAL).alias("currency"),
        F.col("period_date").cast("int").alias("period_date"),
        "metric",
        *[c for c in mapping.columns if c not in _MAPPING_COLUMNS],
    )


def metric_dimensions(labels: DataFrame, facts: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Dictionary (label, metric) widened by the fact's dimensions; unmatched labels stay.

    One row per distinct combination: the copies of a label are merged before the join.
    """
    seen = facts.select("label", "scenario_id", *keep).distinct()
    return labels.join(seen, "label", "left").drop("label")


def attach_dimensions(rows: DataFrame, dimensions: DataFrame, company: int, country: str) -> DataFrame:
    """Report rows with the dimensions of their metric, constant company and country, no duplicates."""
    found = rows.join(dimensions, ["scenario_id", "metric"], "left").drop("metric")
    return found.withColumns({"company_id": F.lit(company), "country": F.lit(country)}).distinct()
