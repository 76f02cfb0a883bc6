"""Year-to-date figures, months by difference and estimate series."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.calendar import is_january, year_of_day, year_of_month, year_start
from ledgerloom.functions.predicates import same_year
from ledgerloom.functions.scenarios import SINGLE_PERIOD, STAGE_IDS, YEAR_TO_DATE
from ledgerloom.functions.types import MONEY, PUBLISHED
from ledgerloom.operators.aggregates import has_data
from ledgerloom.operators.joins import join_keys_null_safe
from ledgerloom.operators.reshape import unpivot_pair
from ledgerloom.operators.setops import union_by_name

LOCAL = "Pesos"
REPORTING = "Euros"
SERIES = (
    "scenario_id", "report_id", "concept_id", "business_id", "dim1_id", "dim2_id", "currency", "company_id",
)


@dataclass(frozen=True)
class Variant:
    """How a report's published table is keyed and how its estimates are continued.

    ``series`` keys the year-to-date totals, ``differences`` the months by difference; ``carried``
    columns travel with the rows without being keys. ``real_closes_estimate`` lets the current real
    month stand for the estimate; ``history_of_mode`` restricts the history of the differences to
    the scenarios of the run mode.
    """

    series: tuple[str, ...] = SERIES
    differences: tuple[str, ...] = SERIES[:-1]
    carried: tuple[str, ...] = ("company_id",)
    real_closes_estimate: bool = True
    history_of_mode: bool = False


STANDARD = Variant()
BY_COST_TYPE = Variant(
    series=(*SERIES[:-2], "cost_type_id"),
    differences=(*SERIES[:-1], "cost_type_id"),
    carried=("company_id", "metric"),
    real_closes_estimate=False,
    history_of_mode=True,
)


def cumulative_by_date(
    df: DataFrame, keys: Sequence[str], date: str, amount: str, out: str = "ytd", year=year_of_day
) -> DataFrame:
    """Per series and date the amount and its running total within the year.

    Rows are summed per (series, date) before the window, so a series reaches its task as one row
    per date however many rows it has. The totals equal those of the default window frame, in which
    rows with the same date share one total.
    """
    per_date = df.groupBy(*keys, date).agg(F.sum(amount).alias(amount))
    window = Window.partitionBy(year(F.col(date)), *keys).orderBy(date)
    return per_date.withColumn(out, F.sum(amount).over(window))


def attach_cumulative(
    df: DataFrame, keys: Sequence[str], date: str, amount: str, out: str = "ytd", year=year_of_day
) -> DataFrame:
    """Every row together with the running total of its series at its date."""
    totals = cumulative_by_date(df, keys, date, amount, out, year).select(*keys, date, out)
    return join_keys_null_safe(df, totals, [*keys, date])


def period_and_ytd(
    df: DataFrame,
    keys: Sequence[str] = SERIES,
    date: str = "period_date",
    amount: str = "amount",
    period: int | None = None,
) -> DataFrame:
    """Each row as a single-period row and as a year-to-date row.

    With a ``period`` only its rows are emitted, and their totals come from one aggregation over
    the year up to it, without a window.
    """
    if period is None:
        rows = attach_cumulative(df, keys, date, amount, "__ytd")
    else:
        year = df.where(F.col(date).between(year_start(period), period))
        totals = year.groupBy(*keys).agg(F.sum(amount).alias("__ytd"))
        rows = join_keys_null_safe(df.where(F.col(date) == period), totals, keys)
    rows = rows.where(F.col(amount).isNotNull())
    typed = rows.withColumns({"__one": F.col(amount).cast(PUBLISHED), "__ytd": F.col("__ytd").cast(PUBLISHED)})
    keep = [c for c in df.columns if c not in (amount, "data_type_id")]
    return unpivot_pair(typed, keep, [("__one", SINGLE_PERIOD), ("__ytd", YEAR_TO_DATE)], "data_type_id", amount)


def difference_from_previous(
    df: DataFrame, keys: Sequence[str], date: str, amount: str, out: str = "difference"
) -> DataFrame:
    """Amount of a date minus that of the previous date that exists in the series, or minus zero.

    Amounts are summed per (series, date) first: one row per date reaches the window.
    """
    per_date = df.groupBy(*keys, date).agg(F.sum(amount).alias(amount))
    window = Window.partitionBy(*keys).orderBy(date)
    previous = F.lag(amount, 1, 0).over(window)
    return per_date.withColumn(out, F.col(amount).cast(PUBLISHED) - previous.cast(PUBLISHED))


def period_by_difference(
    history: DataFrame, current: DataFrame, period: int, variant: Variant = STANDARD
) -> DataFrame:
    """Single-period amounts in the reporting currency, from year-to-date amounts.

    The history gives the year-to-date rows of the year before the period. Estimates continue the
    real series, so real history also serves under the estimate id; estimate history does not count.
    """
    ids = STAGE_IDS["published"]
    wanted = (F.col("data_type_id") == YEAR_TO_DATE) & (F.col("currency") == REPORTING)
    before = F.col("period_date").between(year_start(period), period - 1)
    columns = [*variant.differences, *variant.carried, "period_date", "amount"]
    past = history.where(wanted & before & (F.col("scenario_id") != ids["EST"]))
    # A real month stands for itself and for the estimate series.
    is_real = F.col("scenario_id") == ids["RE"]
    served = F.when(is_real, F.array(F.lit(ids["RE"]), F.lit(ids["EST"]))).otherwise(F.array("scenario_id"))
    past = past.withColumn("scenario_id", F.explode(served)).select(*columns)
    series = past.unionByName(current.where(wanted).select(*columns))
    # Every row of a series carries the total of the whole series, once for each metric that feeds it.
    whole = [*dict.fromkeys([*variant.series, *variant.differences]), "period_date"]
    others = [c for c in variant.carried if c not in whole]
    once = series.groupBy(*whole).agg(F.max("amount").alias("amount"), *[F.max(c).alias(c) for c in others])
    per_date = once.groupBy(*variant.differences, "period_date").agg(
        F.sum("amount").alias("amount"), *[F.max(c).alias(c) for c in variant.carried]
    )
    window = Window.partitionBy(*variant.differences).orderBy("period_date")
    previous = F.lag("amount", 1, 0).over(window)
    return (
        per_date.withColumn("amount", (F.col("amount").cast(PUBLISHED) - previous.cast(PUBLISHED)).cast(PUBLISHED))
        .where((F.col("period_date") == period) & F.col("amount").isNotNull())
        .withColumn("data_type_id", F.lit(SINGLE_PERIOD))
    )


def month_from_fx_cumulative(
    amounts: DataFrame, rates: DataFrame, keys: Sequence[str], period: str, amount: str, rate: str
) -> DataFrame:
    """Month figures from cumulative amounts valued at the rate of each month.

    The running total of a year is multiplied by the month's rate; a month is the difference to the
    month before. January is its own value; where the month before is missing the row is dropped.
    Months without a rate take no part, not even in the running total. ``rates`` holds one row per
    period and scenario.
    """
    monthly = amounts.groupBy(*keys, period).agg(F.sum(amount).alias(amount))
    valued = monthly.join(rates.select("scenario_id", period, rate), ["scenario_id", period])
    by_year = Window.partitionBy(year_of_month(F.col(period)), *keys).orderBy(period)
    valued = valued.withColumn("__value", (F.sum(amount).over(by_year).cast(MONEY) * F.col(rate)).cast(MONEY))
    valued = valued.withColumns(
        {"__before": F.lag("__value").over(by_year), "__period_before": F.lag(period).over(by_year)}
    )
    month = F.when(is_january(F.col(period)), F.col("__value")).when(
        F.col("__period_before") == F.col(period) - 1, F.col("__value") - F.col("__before")
    )
    return valued.select(*keys, period, month.cast(MONEY).alias(amount)).where(F.col(amount).isNotNull())


def estimate_series(
    history: DataFrame, current: DataFrame, period: int, include_current: bool = True
) -> DataFrame:
    """The months of the year that make up the estimate's year-to-date figure.

    Real months before the period stand in for the estimate, followed by estimate months after the
    last real one, followed by the current month: real if there is real data, else the estimate.
    Without estimate data the current estimate rows are all there is. The conditions are scalar
    subqueries, so nothing is fetched to the driver. ``include_current=False`` leaves out the
    current month and, without estimate data, every row: the second report variant, whose callers
    add the current rows themselves.
    """
    ids = STAGE_IDS["published"]
    single = F.col("data_type_id") == SINGLE_PERIOD
    now = current.where(single & (F.col("period_date") == period))
    now_estimate = now.where(F.col("scenario_id") == ids["EST"])
    now_real = now.where(F.col("scenario_id") == ids["RE"])
    estimated, real = has_data(now_estimate, "amount"), has_data(now_real, "amount")

    usable = history.where(
        single & (F.col("currency") == LOCAL) & same_year("period_date", period) & (F.col("period_date") < period)
    )
    past_real = usable.where(F.col("scenario_id") == ids["RE"])
    last_real = F.coalesce(past_real.agg(F.max("period_date")).scalar(), F.lit(0))
    past_estimate = usable.where((F.col("scenario_id") == ids["EST"]) & (F.col("period_date") > last_real))
    parts = [past_real.where(estimated), past_estimate.where(estimated)]
    if include_current:
        parts.append(now_real.where(estimated & real))
        parts.append(now_estimate.where(~(estimated & real)))
    return union_by_name(*parts).withColumn("scenario_id", F.lit(ids["EST"]))
