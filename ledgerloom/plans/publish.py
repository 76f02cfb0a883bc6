"""The monthly publication: report rows of a period to the published table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.calendar import year_start
from ledgerloom.functions.scalars import null_text
from ledgerloom.functions.scenarios import SINGLE_PERIOD, STAGE_IDS, scenario_ids, select_scenarios
from ledgerloom.functions.types import PUBLISHED
from ledgerloom.operators.setops import union_by_name
from ledgerloom.plans.currency import currency_block, pass_through, rewrite_rate_concept
from ledgerloom.plans.periods import (
    LOCAL,
    STANDARD,
    Variant,
    estimate_series,
    period_and_ytd,
    period_by_difference,
)
from ledgerloom.session import new_path, stage_scope
from ledgerloom.sources.sinks import replace_slice, stage_boundary
from ledgerloom.sources.tables import literal_table, read_slice

PUBLISHED_COLUMNS = [
    "report_id", "concept_id", "business_id", "company_id", "data_type_id", "dim1_id", "dim2_id",
    "scenario_id", "amount", "currency", "period_date",
]
_RATES = ["rate_acc", "rate_month"]
# Types of the stored columns; the cost type is stored by the variant that keys its rows by it.
_STORED = {
    "report_id": "int", "concept_id": "int", "business_id": "string", "company_id": "int", "data_type_id": "int",
    "dim1_id": "int", "dim2_id": "int", "scenario_id": "int", "amount": PUBLISHED.simpleString(),
    "currency": "string", "period_date": "int", "cost_type_id": "int",
}


def _columns(variant: Variant) -> list[str]:
    extra = [c for c in (*variant.series, *variant.carried) if c not in PUBLISHED_COLUMNS]
    return [*PUBLISHED_COLUMNS, *extra]


def year_to_date_rows(
    current: DataFrame, history: DataFrame, period: int, variant: Variant = STANDARD
) -> DataFrame:
    """Single-period and year-to-date rows of the period in the local currency.

    Estimates are continued by the real months of the year; the other scenarios by their own.
    """
    estimate = STAGE_IDS["published"]["EST"]
    earlier = history.where(
        F.col("period_date").between(year_start(period), period - 1)
        & (F.col("scenario_id") != estimate)
        & (F.col("data_type_id") == SINGLE_PERIOD)
        & (F.col("currency") == LOCAL)
    )
    closing = variant.real_closes_estimate
    now = current.where(F.col("scenario_id") != estimate) if closing else current
    continued = estimate_series(history, current, period, include_current=closing)
    series = union_by_name(now, earlier, continued).select(*_columns(variant), *_RATES)
    cleaned = series.withColumns(
        {c: null_text(F.col(c).cast("string")).cast("int") for c in ("dim1_id", "dim2_id")}
    )
    rows = period_and_ytd(cleaned, variant.series, period=period)
    return rows.withColumn("company_id", F.lit(None).cast("int"))


def finish(
    ytd_rows: DataFrame, history: DataFrame, period: int, mode: str, variant: Variant = STANDARD
) -> DataFrame:
    """Currencies, differences and special concepts; the rows to publish for a run mode."""
    columns = _columns(variant)
    converted = currency_block(select_scenarios(ytd_rows, mode, "published"))
    past = select_scenarios(history, mode, "published") if variant.history_of_mode else history
    differences = period_by_difference(past, converted, period, variant)
    merged = union_by_name(
        converted.where(F.col("period_date") == period).select(*columns), differences.select(*columns)
    )
    final = pass_through(rewrite_rate_concept(merged))
    return select_scenarios(final, mode, "published").select(
        *[F.col(c).cast(PUBLISHED) if c == "amount" else F.col(c) for c in columns]
    )


def published_rows(
    current: DataFrame, history: DataFrame, period: int, mode: str = "ALL", variant: Variant = STANDARD
) -> DataFrame:
    """Rows the publication of ``period`` adds to the published table."""
    return finish(year_to_date_rows(current, history, period, variant), history, period, mode, variant)


def read_published(
    spark: SparkSession, table: str, variant: Variant = STANDARD, first_month: bool = False
) -> DataFrame:
    """The published table. Only a first month may find none; it then has no rows.

    The columns are known, so Spark need not open files to learn them. Carried columns that are not
    stored are null.
    """
    columns = _columns(variant)
    schema = ", ".join(f"{c} {_STORED[c]}" for c in columns if c in _STORED)
    try:
        stored = spark.read.schema(schema).parquet(table)
    except AnalysisException as error:
        if not first_month or error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = literal_table(spark, schema, [])
    return stored.withColumns({c: F.lit(None).cast("string") for c in columns if c not in _STORED})


def publish(
    current: DataFrame,
    table: str,
    period: int,
    mode: str = "ALL",
    variant: Variant = STANDARD,
    describe=None,
    series: str | None = None,
    first_month: bool = False,
) -> DataFrame:
    """Publish into the table at ``table`` and return the stored slice.

    Each stage is stored and read back: several later branches start from it, and replacing the
    slice must not read the part of the table that is being replaced. Stages are removed at the end. ``describe`` may turn the
    final rows into those of the table, for example by attaching dimensions. An amount then stands
    once per dimension value, so the rows before it are kept in the table ``series`` as well, and
    later months continue that one. A missing table is an error unless this is the ``first_month``.
    """
    spark = current.sparkSession
    if (describe is None) != (series is None):
        raise ValueError("described rows need a table for the series, others none")

    def stored(df: DataFrame, stage: str) -> DataFrame:
        return stage_boundary(df, new_path(spark, stage), ["period_date"], {"period_date": period})

    with stage_scope(spark):
        history = read_published(spark, series or table, variant, first_month).where(F.col("period_date") < period)
        reported = stored(current, "reported")
        cumulated = stored(year_to_date_rows(reported, history, period, variant), "cumulated")
        final = finish(cumulated, history, period, mode, variant)
        final = stored(final, "final")
        slice_of = ("period_date", period, "scenario_id", scenario_ids(mode, "published"))
        if series is not None:
            replace_slice(final, series, *slice_of)
        replace_slice(final if describe is None else describe(final), table, *slice_of)
    return select_scenarios(read_slice(spark, table, {"period_date": period}), mode, "published")
