"""One month from masters to the published table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.calendar import first_day
from ledgerloom.functions.scenarios import select_scenarios
from ledgerloom.plans.facts import build_fact, label_rows, union_masters
from ledgerloom.plans.formulas import Formula, apply_formulas
from ledgerloom.plans.keys import extend_dimension, store_labels
from ledgerloom.plans.periods import STANDARD, Variant
from ledgerloom.plans.publish import publish
from ledgerloom.plans.reports import report_rows
from ledgerloom.plans.wide import build_wide
from ledgerloom.session import new_path, stage_scope
from ledgerloom.sources.sinks import stage_boundary


@dataclass(frozen=True)
class Month:
    """What a run needs besides its tables: period ``yyyymm``, run mode and business configuration."""

    period: int
    mode: str
    labels: Mapping[str, str]
    formulas: Sequence[Formula]
    rate_acc: str
    rate_month: str
    process_codes: Mapping[str, int] | None = None
    noise: str | None = None
    variant: Variant = field(default=STANDARD)
    first_month: bool = False


def build_metrics(
    month: Month,
    masters: tuple[DataFrame, DataFrame, DataFrame],
    dimension: DataFrame | str,
    costs: DataFrame | None = None,
    asked: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The extended dimension and the wide metrics of the month, formulas included.

    A ``dimension`` given by its path is one that is stored: new labels are appended to it. With
    ``asked`` only formulas that these metrics need are computed; names that are no metric are ignored.
    """
    rows = union_masters(month.mode, *masters).where(F.col("period") == str(month.period))
    labels = label_rows(rows).select("kpi_label")
    if isinstance(dimension, str):
        known = store_labels(labels, dimension, "kpi_id", "kpi_label")
    else:
        known = extend_dimension(labels, dimension, "kpi_id", "kpi_label")
    fact = stage_boundary(
        build_fact(rows, known, month.process_codes), new_path(rows.sparkSession, "fact"), ["period"],
        {"period": month.period},
    )
    chosen = select_scenarios(fact, month.mode, "fact")
    wide = build_wide(chosen, known, month.labels, costs, month.noise)
    wanted = None
    if asked is not None:
        defined = {f.name for f in month.formulas}
        wanted = [name for name in dict.fromkeys(asked) if name in defined]
    return known, apply_formulas(wide, month.formulas, wanted=wanted)


def run_month(
    month: Month,
    masters: tuple[DataFrame, DataFrame, DataFrame],
    dimension: DataFrame | str,
    mapping: DataFrame,
    table: str,
    costs: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Publish the month; returns the extended dimension and the published slice.

    With the path of a stored dimension no stage is left after the run.
    """
    if isinstance(dimension, str):
        with stage_scope(mapping.sparkSession):
            return _publish_month(month, masters, dimension, mapping, table, costs)
    return _publish_month(month, masters, dimension, mapping, table, costs)


def _publish_month(month, masters, dimension, mapping, table, costs):
    # The mapping is configuration, a row per report row; its metrics are those worth computing.
    mapped = {r[0] for r in mapping.select("metric").distinct().collect()}
    known, wide = build_metrics(month, masters, dimension, costs, [*mapped, month.rate_acc, month.rate_month])
    dated = wide.withColumn("period_date", first_day(F.col("period")))
    metrics = [c for c in dated.columns if c not in ("period", "period_date", "scenario_id") and c in mapped]
    rows = report_rows(dated, mapping, metrics, month.rate_acc, month.rate_month)
    if "metric" not in month.variant.carried:
        rows = rows.drop("metric")
    return known, publish(rows, table, month.period * 100 + 1, month.mode, month.variant, first_month=month.first_month)
