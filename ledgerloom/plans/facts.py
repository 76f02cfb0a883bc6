"""The KPI fact: masters to typed, coded, keyed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import clean_unit, code_of, composite_label
from ledgerloom.functions.scenarios import RUN_MODES, fact_scenario_id
from ledgerloom.functions.types import MONEY, SOURCE_MONEY
from ledgerloom.operators.dedup import dedup_subset
from ledgerloom.operators.joins import computed_key_join

MASTER_COLUMNS = [
    "scenario", "period", "business_unit", "company", "country", "product", "origin", "channel",
    "process", "kpi_name", "kpi_code", "value", "measure_unit", "period_type",
]

# Processes and their codes; anything else is 6.
PROCESS_CODES = {
    "Costes Fijos": 1,
    "Márgenes, Ventas y Costes Variables": 2,
    "Cuenta de resultados": 3,
    "Indicadores operativos": 4,
    "Resultados generados": 5,
}
OTHER_PROCESS = 6

FACT_KEY = [
    "period", "scenario_id", "business_unit", "country", "process_id", "kpi_id", "measure_unit", "value",
]


def union_masters(mode: str, real: DataFrame, budget: DataFrame, estimate: DataFrame) -> DataFrame:
    """The masters a run mode needs; estimates carry no period type."""
    estimate = estimate.select(*[c for c in MASTER_COLUMNS if c != "period_type"])
    estimate = estimate.withColumn("period_type", F.lit("undefined")).select(*MASTER_COLUMNS)
    sources = {"EST": estimate, "REAL": real, "PA": budget, "UPA": budget, "PA-UPA": budget}
    if RUN_MODES[mode] is not None:
        return sources[mode].select(*MASTER_COLUMNS)
    return real.select(*MASTER_COLUMNS).unionByName(budget.select(*MASTER_COLUMNS)).unionByName(estimate)


def label_rows(masters: DataFrame, keep: Sequence[Column] = ()) -> DataFrame:
    """The composite KPI labels, once per combination of their parts and the columns to keep.

    The parts are made distinct before the text work, so rows are combined where they are read.
    """
    parts = masters.select("business_unit", "kpi_name", "product", *keep).distinct()
    kept = [c for c in parts.columns if c not in ("business_unit", "kpi_name", "product")]
    label = composite_label(clean_unit("business_unit"), "kpi_name", "product")
    return parts.select(label.alias("kpi_label"), *kept)


def build_fact(masters: DataFrame, dimension: DataFrame, process_codes: dict | None = None) -> DataFrame:
    """Keyed and coded fact rows, one per business key.

    Amounts are rounded to two places before they are widened again, and the remaining columns of
    rows with equal keys are settled by their smallest combination.
    """
    rows = masters.withColumn("business_unit", clean_unit("business_unit"))
    label = composite_label("business_unit", "kpi_name", "product")
    known = dimension.select("kpi_id", "kpi_label")
    keyed = computed_key_join(rows, known, label, "kpi_label")
    typed = keyed.select(
        F.lit(1).alias("record_id"),
        F.col("period").try_cast("int").alias("period"),
        fact_scenario_id("scenario").alias("scenario_id"),
        "product",
        "origin",
        code_of("process", process_codes or PROCESS_CODES, OTHER_PROCESS).alias("process_id"),
        F.col("kpi_id").cast("int").alias("kpi_id"),
        "country",
        "channel",
        "kpi_code",
        "measure_unit",
        "period_type",
        "company",
        "business_unit",
        F.col("value").try_cast(SOURCE_MONEY).cast(MONEY).alias("value"),
        F.lit(0).alias("computed"),
    )
    return dedup_subset(typed, FACT_KEY)


def keyed_amounts(masters: DataFrame, process_codes: dict | None = None) -> DataFrame:
    """The business keys of the fact, each once, with the label in place of the id it has in a dimension.

    For readers of nothing but keys and amounts: no columns beside the key are carried or settled, so
    rows are made distinct by hash, without a sort, and before they meet the dimension. Labels
    that a dimension lacks are still apart here; in the fact they share the null id.
    """
    rows = masters.withColumn("business_unit", clean_unit("business_unit"))
    return rows.select(
        F.col("period").try_cast("int").alias("period"),
        fact_scenario_id("scenario").alias("scenario_id"),
        "business_unit",
        "country",
        code_of("process", process_codes or PROCESS_CODES, OTHER_PROCESS).alias("process_id"),
        composite_label("business_unit", "kpi_name", "product").alias("kpi_label"),
        "measure_unit",
        F.col("value").try_cast(SOURCE_MONEY).alias("value"),
    ).distinct()
