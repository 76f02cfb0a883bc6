"""Corporate costs: spine, pivot, monthly result, services, exchange rate and sign."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scenarios import STAGE_IDS
from ledgerloom.functions.types import MONEY
from ledgerloom.operators.joins import full_outer_left_keys, spine_join
from ledgerloom.operators.reshape import pivot_sum


def scenario_spine(periods: DataFrame, scenarios: Sequence[int]) -> DataFrame:
    """Every period once per scenario, so that a scenario without data still has a row."""
    return periods.select("period", F.explode(F.array(*[F.lit(s) for s in scenarios])).alias("scenario_id"))


def with_fallback(spine: DataFrame, df: DataFrame, value: str) -> DataFrame:
    """One row per spine entry with the value found for it, else null."""
    return spine.join(df.select("period", "scenario_id", value), ["period", "scenario_id"], "left")


def cost_columns(costs: DataFrame, spine: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Costs per (period, scenario) as columns ``unit_kpi``, all labels present."""
    summed = costs.groupBy("period", "scenario_id", "unit_id", "kpi").agg(F.sum("amount").alias("amount"))
    renamed = summed.withColumnsRenamed({"period": "cost_period", "scenario_id": "cost_scenario"})
    dense = spine_join(spine, renamed, {"period": "cost_period", "scenario_id": "cost_scenario"})
    labelled = dense.withColumn("label", F.concat(F.col("unit_id").cast("string"), F.lit("_"), F.col("kpi")))
    return pivot_sum(labelled, ["period", "scenario_id"], "label", "amount", labels)


def cost_block(
    wide: DataFrame,
    results: DataFrame,
    services: DataFrame,
    rates: DataFrame,
    metrics: Sequence[str],
    flipped: Mapping[int, Sequence[str]],
    result: str = "result",
) -> DataFrame:
    """Costs, services and the monthly result of each scenario in the local currency.

    ``wide``, ``results``, ``services`` and ``rates`` hold one row per (period, scenario). The
    result is kept as it is, all other metrics are multiplied by the rate rounded half-even to two
    places, with the sign turned for the metrics listed per scenario. A scenario without a rate
    yields no row.
    """
    renamed = results.select(
        F.col("period").alias("result_period"), F.col("scenario_id").alias("result_scenario"), result
    )
    joined = full_outer_left_keys(wide, renamed, {"period": "result_period", "scenario_id": "result_scenario"})
    joined = joined.join(services, ["period", "scenario_id"], "left")
    rated = joined.join(
        rates.select("period", "scenario_id", F.bround("rate", 2).alias("rate")), ["period", "scenario_id"]
    )
    columns = []
    for metric in metrics:
        scenarios = [s for s, names in flipped.items() if metric in names]
        sign = F.when(F.col("scenario_id").isin(scenarios), F.lit(-1)).otherwise(F.lit(1)) if scenarios else F.lit(1)
        columns.append((F.col(metric).cast(MONEY) * F.col("rate") * sign).cast(MONEY).alias(metric))
    source, fact = STAGE_IDS["costs"], STAGE_IDS["fact"]
    restaged = F.when(F.col("scenario_id") == source["RE"], fact["RE"]).otherwise(fact["PA"])
    return rated.select(
        F.col("period").cast("int").alias("period"),
        restaged.cast("int").alias("scenario_id"),
        F.col(result).cast(MONEY).alias(result),
        *columns,
    )
