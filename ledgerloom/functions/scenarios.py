"""Scenarios, their per-stage ids and the run modes that select them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import code_of

# Ids differ between the stages, see README.
STAGE_IDS = {
    "fact": {"RE": 3, "PA": 2, "UPA": 4, "EST": 1},
    "published": {"RE": 1, "PA": 2, "UPA": 3, "EST": 4},
    "costs": {"RE": 1, "PA": 2},
}

# Run mode -> scenarios that flow; ALL applies no filter.
RUN_MODES = {
    "ALL": None,
    "PA-UPA": ("PA", "UPA"),
    "EST": ("EST",),
    "REAL": ("RE",),
    "PA": ("PA",),
    "UPA": ("UPA",),
}

YEAR_TO_DATE = 1
SINGLE_PERIOD = 2


def scenario_ids(mode: str, stage: str) -> list[int] | None:
    """Ids of a run mode in a stage, ``None`` for no restriction."""
    names = RUN_MODES[mode]
    return None if names is None else [STAGE_IDS[stage][name] for name in names]


def select_scenarios(df: DataFrame, mode: str, stage: str, column: str = "scenario_id") -> DataFrame:
    ids = scenario_ids(mode, stage)
    return df if ids is None else df.where(F.col(column).isin(ids))


def fact_scenario_id(column: str | Column) -> Column:
    """Scenario text to its fact id; anything unknown counts as an estimate."""
    ids = STAGE_IDS["fact"]
    return code_of(column, {name: ids[name] for name in ("RE", "PA", "UPA")}, ids["EST"])


def published_scenario_id(column: str | Column) -> Column:
    ids = STAGE_IDS["published"]
    return code_of(column, {name: ids[name] for name in ("RE", "PA", "UPA")}, ids["EST"])


def restage_scenario(column: str | Column, source: str, target: str) -> Column:
    """Id of one stage to the id of another."""
    pairs = {STAGE_IDS[source][n]: STAGE_IDS[target][n] for n in STAGE_IDS[source] if n in STAGE_IDS[target]}
    return code_of(column, pairs, None).cast("int")
