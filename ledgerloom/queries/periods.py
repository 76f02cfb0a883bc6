"""Year-to-date, differences between months, estimates and currencies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.scenarios import fact_scenario_id
from ledgerloom.functions.types import MONEY, PUBLISHED
from ledgerloom.operators.reshape import pivot_sum, unpivot_metrics
from ledgerloom.plans.currency import currency_block, pass_through, rewrite_rate_concept
from ledgerloom.plans.formulas import apply_formulas, ratio, total
from ledgerloom.plans.periods import (
    LOCAL,
    SERIES,
    attach_cumulative,
    cumulative_by_date,
    difference_from_previous,
    estimate_series,
    month_from_fx_cumulative,
    period_and_ytd,
    period_by_difference,
)
from ledgerloom.functions.calendar import year_of_month
from ledgerloom.queries.base import (
    FACT_ID_SQL,
    KPI_FACT_SQL,
    LABELS,
    RATES_SQL,
    REPORT_CTES,
    kpi_fact,
    rates,
    sql_reporting_amount,
    stored_report_rows,
)
from ledgerloom.queries.registry import query

PERIOD = 19980601

# ---------------------------------------------------------------------------------------- flagship

_FLAGSHIP_METRICS = ["m_total", "m_basic", "m_premium", "m_gap", "m_share"]
_FLAGSHIP_FORMULAS = [
    total("m_basic", "m_economy", "m_small", "m_standard"),
    total("m_premium", "m_promo", "m_large", "m_medium"),
    total("m_total", "m_basic", "m_premium"),
    total("m_gap", "m_premium", minus=["m_basic"]),
    ratio("m_share", "m_basic", "m_total"),
]


@query(
    "monthly_kpis",
    f"""WITH {KPI_FACT_SQL}, w AS (SELECT period, {FACT_ID_SQL.format("scenario")} AS scenario_id,
      sum(value) FILTER (WHERE name IN ('ECONOMY', 'SMALL', 'STANDARD')) AS m_basic,
      sum(value) FILTER (WHERE name IN ('PROMO', 'LARGE', 'MEDIUM')) AS m_premium FROM kpi_fact GROUP BY 1, 2),
    f AS (SELECT period, scenario_id, coalesce(m_basic, 0) AS m_basic, coalesce(m_premium, 0) AS m_premium FROM w),
    long AS (SELECT period, scenario_id, 'm_basic' AS metric, m_basic AS amount FROM f
      UNION ALL SELECT period, scenario_id, 'm_premium', m_premium FROM f
      UNION ALL SELECT period, scenario_id, 'm_total', m_basic + m_premium FROM f
      UNION ALL SELECT period, scenario_id, 'm_gap', m_premium - m_basic FROM f
      UNION ALL SELECT period, scenario_id, 'm_share', CAST(CAST(m_basic AS DOUBLE) / CAST(m_basic + m_premium AS DOUBLE) AS DECIMAL(24,10))
        FROM f WHERE m_basic + m_premium <> 0)
    SELECT period, scenario_id, metric, CAST(amount AS DECIMAL(24,3)) AS amount,
      CAST(sum(amount) OVER (PARTITION BY period // 100, scenario_id, metric ORDER BY period) AS DECIMAL(24,3)) AS ytd FROM long""",
)
def monthly_kpis(spark, sf_dir):
    """Fact to wide metrics to formulas to long rows with their year-to-date totals."""
    fact = kpi_fact(spark, sf_dir).select("period", fact_scenario_id("scenario").alias("scenario_id"), "name", "value")
    labels = [name for name in LABELS if name != "LUXURY"]
    wide = pivot_sum(fact, ["period", "scenario_id"], "name", "value", labels)
    wide = wide.withColumnsRenamed({label: LABELS[label] for label in labels})
    derived = apply_formulas(wide, _FLAGSHIP_FORMULAS).withColumn("m_share", F.col("m_share").cast(MONEY))
    long = unpivot_metrics(derived, ["period", "scenario_id"], _FLAGSHIP_METRICS)
    result = cumulative_by_date(long, ["scenario_id", "metric"], "period", "amount", year=year_of_month)
    return result.select(
        "period",
        "scenario_id",
        "metric",
        F.col("amount").cast(PUBLISHED).alias("amount"),
        F.col("ytd").cast(PUBLISHED).alias("ytd"),
    )


# ----------------------------------------------------------------------------------- year to date

_SERIES_SQL = "SELECT period, scenario, unit, name, product, value FROM kpi_fact"


@query(
    "ytd_cumulative",
    f"""WITH {KPI_FACT_SQL} SELECT period, scenario, unit, name, product, value, CAST(sum(value) OVER (PARTITION BY period // 100, scenario, unit, name, product
    ORDER BY period) AS DECIMAL(24,10)) AS ytd FROM kpi_fact""",
)
def ytd_cumulative(spark, sf_dir):
    """Row level: rows of one month share their total, and null products form a series."""
    fact = kpi_fact(spark, sf_dir)
    keys = ["scenario", "unit", "name", "product"]
    rows = attach_cumulative(fact, keys, "period", "value", year=year_of_month)
    return rows.withColumn("ytd", F.col("ytd").cast(MONEY))


@query(
    "period_and_ytd",
    f"""WITH {REPORT_CTES}, y AS (SELECT *, sum(amount) OVER (PARTITION BY period_date // 10000, scenario_id, report_id, concept_id, business_id,
      dim1_id, dim2_id, currency, company_id ORDER BY period_date) AS ytd FROM report_rows)
    SELECT report_id, concept_id, business_id, company_id, dim1_id, dim2_id, scenario_id, rate_acc, rate_month, currency, period_date, metric,
      2 AS data_type_id, CAST(amount AS DECIMAL(24,3)) AS amount FROM y
    UNION ALL SELECT report_id, concept_id, business_id, company_id, dim1_id, dim2_id, scenario_id, rate_acc, rate_month, currency, period_date, metric,
      1, CAST(ytd AS DECIMAL(24,3)) FROM y""",
)
def period_and_ytd_query(spark, sf_dir):
    return period_and_ytd(stored_report_rows(spark, sf_dir))


@query(
    "period_and_ytd_current",
    f"""WITH {REPORT_CTES}, y AS (SELECT *, sum(amount) OVER (PARTITION BY period_date // 10000, scenario_id, report_id, concept_id, business_id,
      dim1_id, dim2_id, currency, company_id ORDER BY period_date) AS ytd FROM report_rows)
    SELECT report_id, concept_id, dim1_id, dim2_id, scenario_id, period_date, 2 AS data_type_id, CAST(amount AS DECIMAL(24,3)) AS amount
      FROM y WHERE period_date = {PERIOD}
    UNION ALL SELECT report_id, concept_id, dim1_id, dim2_id, scenario_id, period_date, 1, CAST(ytd AS DECIMAL(24,3)) FROM y WHERE period_date = {PERIOD}""",
)
def period_and_ytd_current(spark, sf_dir):
    """One period only: its totals come from an aggregation instead of a window."""
    rows = period_and_ytd(stored_report_rows(spark, sf_dir), SERIES, period=PERIOD)
    return rows.select(
        "report_id", "concept_id", "dim1_id", "dim2_id", "scenario_id", "period_date", "data_type_id", "amount"
    )


# ------------------------------------------------------------------------------------ differences


@query(
    "lag_previous",
    f"""WITH {KPI_FACT_SQL}, m AS (SELECT scenario, unit, name, period, CAST(sum(value) AS DECIMAL(24,3)) AS amount FROM kpi_fact GROUP BY 1, 2, 3, 4)
    SELECT scenario, unit, name, period, amount, CAST(amount - lag(amount, 1, 0) OVER (PARTITION BY scenario, unit, name ORDER BY period) AS DECIMAL(24,3)) AS difference
    FROM m""",
)
def lag_previous(spark, sf_dir):
    rows = difference_from_previous(kpi_fact(spark, sf_dir), ["scenario", "unit", "name"], "period", "value")
    return rows.select(
        "scenario", "unit", "name", "period", F.col("value").cast(PUBLISHED).alias("amount"),
        F.col("difference").cast(PUBLISHED).alias("difference"),
    )


@query(
    "month_from_fx_cumulative",
    f"""WITH {KPI_FACT_SQL}, {RATES_SQL}, m AS (SELECT {FACT_ID_SQL.format("scenario")} AS scenario_id, unit, name, period, sum(value) AS amount
      FROM kpi_fact GROUP BY 1, 2, 3, 4),
    fx AS (SELECT DISTINCT {FACT_ID_SQL.format("scenario")} AS scenario_id, period, rate_month AS rate FROM kpi_fact JOIN rates ON period // 100 = year
      WHERE scenario IN ('RE', 'PA') AND period % 100 <> 7),
    v AS (SELECT scenario_id, unit, name, period, CAST(CAST(sum(amount) OVER (PARTITION BY period // 100, scenario_id, unit, name ORDER BY period) AS DECIMAL(20,2))
      * CAST(rate AS DECIMAL(10,4)) AS DECIMAL(24,10)) AS value FROM m JOIN fx USING (scenario_id, period))
    SELECT c.scenario_id, c.unit, c.name, c.period, CAST(CASE WHEN c.period % 100 = 1 THEN c.value ELSE c.value - p.value END AS DECIMAL(24,10)) AS amount
    FROM v AS c LEFT JOIN v AS p ON p.scenario_id = c.scenario_id AND p.unit = c.unit AND p.name = c.name AND p.period = c.period - 1
      AND p.period // 100 = c.period // 100
    WHERE c.period % 100 = 1 OR p.value IS NOT NULL""",
)
def month_from_fx_cumulative_query(spark, sf_dir):
    """Rates exist for two scenarios and never for July, so that months before are missing."""
    fact = kpi_fact(spark, sf_dir).withColumn("scenario_id", fact_scenario_id("scenario"))
    known = fact.where(F.col("scenario").isin("RE", "PA") & (F.col("period") % 100 != 7))
    spine = known.select("scenario_id", "period").distinct().withColumn("year", year_of_month(F.col("period")))
    fx = spine.join(rates(spark), "year").select("scenario_id", "period", F.col("rate_month").alias("rate"))
    keys = ["scenario_id", "unit", "name"]
    return month_from_fx_cumulative(fact, fx, keys, "period", "value", "rate").withColumnRenamed("value", "amount")


# -------------------------------------------------------------------------------------- estimates

# In the history of the estimate queries the real figures end two months before the period.
_LAST_REAL = 19980301
_ESTIMATE_PARTS = f"""past AS (SELECT * FROM report_rows WHERE period_date < {PERIOD} AND period_date // 10000 = {PERIOD // 10000}
      AND (scenario_id <> 1 OR period_date <= {_LAST_REAL})),
    past_real AS (SELECT * FROM past WHERE scenario_id = 1),
    past_estimate AS (SELECT * FROM past WHERE scenario_id = 4 AND period_date > (SELECT coalesce(max(period_date), 0) FROM past_real)),
    assembled AS (SELECT * FROM past_real UNION ALL SELECT * FROM past_estimate)"""
_ESTIMATE_COLUMNS = "report_id, concept_id, business_id, dim1_id, dim2_id, 4 AS scenario_id, amount, period_date, metric"


def _estimate_inputs(spark, sf_dir):
    rows = stored_report_rows(spark, sf_dir)
    real_missing = (F.col("scenario_id") == 1) & (F.col("period_date") > _LAST_REAL)
    history = rows.where((F.col("period_date") < PERIOD) & ~real_missing)
    return history, rows.where(F.col("period_date") == PERIOD)


def _estimate_output(rows):
    return rows.select(
        "report_id", "concept_id", "business_id", "dim1_id", "dim2_id", "scenario_id", "amount", "period_date", "metric"
    )


@query(
    "estimate_ytd",
    f"""WITH {REPORT_CTES}, {_ESTIMATE_PARTS} SELECT {_ESTIMATE_COLUMNS} FROM assembled
    UNION ALL SELECT {_ESTIMATE_COLUMNS} FROM report_rows WHERE period_date = {PERIOD} AND scenario_id = 1""",
)
def estimate_ytd(spark, sf_dir):
    history, current = _estimate_inputs(spark, sf_dir)
    return _estimate_output(estimate_series(history, current, PERIOD))


@query(
    "estimate_ytd_without_real",
    f"""WITH {REPORT_CTES}, {_ESTIMATE_PARTS} SELECT {_ESTIMATE_COLUMNS} FROM assembled
    UNION ALL SELECT {_ESTIMATE_COLUMNS} FROM report_rows WHERE period_date = {PERIOD} AND scenario_id = 4""",
)
def estimate_ytd_without_real(spark, sf_dir):
    history, current = _estimate_inputs(spark, sf_dir)
    return _estimate_output(estimate_series(history, current.where(F.col("scenario_id") != 1), PERIOD))


@query(
    "estimate_ytd_history",
    f"WITH {REPORT_CTES}, {_ESTIMATE_PARTS} SELECT {_ESTIMATE_COLUMNS} FROM assembled",
)
def estimate_ytd_history(spark, sf_dir):
    history, current = _estimate_inputs(spark, sf_dir)
    return _estimate_output(estimate_series(history, current, PERIOD, include_current=False))


# --------------------------------------------------------------------------------------- currency

_YTD_SQL = """ytd AS (SELECT *, CAST(sum(amount) OVER (PARTITION BY period_date // 10000, scenario_id, report_id, concept_id, business_id,
      dim1_id, dim2_id, currency, company_id ORDER BY period_date) AS DECIMAL(24,3)) AS ytd FROM report_rows),
    both_types AS (SELECT report_id, concept_id, business_id, company_id, dim1_id, dim2_id, scenario_id, rate_acc, rate_month, currency, period_date,
      2 AS data_type_id, amount FROM ytd UNION ALL SELECT report_id, concept_id, business_id, company_id, dim1_id, dim2_id, scenario_id, rate_acc,
      rate_month, currency, period_date, 1, ytd FROM ytd)"""
_BLOCK_COLUMNS = "report_id, concept_id, business_id, company_id, dim1_id, dim2_id, scenario_id, period_date, data_type_id"
_BLOCK_SQL = f"""merged AS (SELECT DISTINCT * FROM (SELECT {_BLOCK_COLUMNS}, rate_acc, rate_month, 'Pesos' AS currency, CAST(amount AS DECIMAL(24,10)) AS amount FROM both_types
      UNION ALL SELECT {_BLOCK_COLUMNS}, rate_acc, rate_month, 'Euros', {sql_reporting_amount("amount", "rate_acc")} FROM both_types
      WHERE data_type_id = 1) AS u),
    block AS (SELECT {_BLOCK_COLUMNS}, currency, amount FROM merged WHERE currency = 'Pesos' OR concept_id IS NOT NULL)"""
BLOCK_CTES = f"{REPORT_CTES}, {_YTD_SQL}, {_BLOCK_SQL}"


def base_block(report_rows):
    """Local and reporting rows of all periods."""
    return currency_block(period_and_ytd(report_rows).drop("metric"))


def _block_output(rows):
    return rows.select(*[c.strip() for c in _BLOCK_COLUMNS.split(",")], "currency", "amount")


@query("currency_block", f"WITH {BLOCK_CTES} SELECT {_BLOCK_COLUMNS}, currency, amount FROM block")
def currency_block_query(spark, sf_dir):
    return _block_output(base_block(stored_report_rows(spark, sf_dir)))


@query(
    "rate_rewrite",
    f"""WITH {BLOCK_CTES}, r AS (SELECT {_BLOCK_COLUMNS}, currency, CAST(amount AS DECIMAL(24,3)) AS amount FROM block)
    SELECT * FROM r WHERE data_type_id = 2 OR (data_type_id = 1 AND concept_id <> 1)
    UNION ALL SELECT * REPLACE (1 AS data_type_id) FROM r WHERE data_type_id = 2 AND concept_id = 1""",
)
def rate_rewrite(spark, sf_dir):
    return _block_output(rewrite_rate_concept(base_block(stored_report_rows(spark, sf_dir))))


@query(
    "passthrough",
    f"""WITH {BLOCK_CTES}, r AS (SELECT {_BLOCK_COLUMNS}, currency, CAST(amount AS DECIMAL(24,3)) AS amount FROM block)
    SELECT * FROM r WHERE currency = 'Pesos' OR (currency = 'Euros' AND concept_id NOT IN (1, 2, 3, 4, 28))
    UNION ALL SELECT * REPLACE ('Euros' AS currency) FROM r WHERE currency = 'Pesos' AND concept_id IN (1, 2, 3, 4, 28)""",
)
def passthrough(spark, sf_dir):
    return _block_output(pass_through(base_block(stored_report_rows(spark, sf_dir))))


_DIFFERENCE_KEYS = "scenario_id, report_id, concept_id, business_id, dim1_id, dim2_id, currency"


@query(
    "month_by_difference",
    f"""WITH {BLOCK_CTES}, e AS (SELECT *, CAST(amount AS DECIMAL(24,3)) AS ytd FROM block WHERE data_type_id = 1 AND currency = 'Euros'),
    series AS (SELECT {_DIFFERENCE_KEYS}, period_date, ytd FROM e
        WHERE period_date >= {PERIOD // 10000 * 10000 + 101} AND period_date < {PERIOD} AND scenario_id <> 4
      UNION ALL SELECT 4, report_id, concept_id, business_id, dim1_id, dim2_id, currency, period_date, ytd FROM e
        WHERE period_date >= {PERIOD // 10000 * 10000 + 101} AND period_date < {PERIOD} AND scenario_id = 1
      UNION ALL SELECT {_DIFFERENCE_KEYS}, period_date, ytd FROM e WHERE period_date = {PERIOD}),
    summed AS (SELECT {_DIFFERENCE_KEYS}, period_date, sum(ytd) AS ytd FROM series GROUP BY ALL),
    d AS (SELECT *, CAST(ytd - lag(ytd, 1, 0) OVER (PARTITION BY {_DIFFERENCE_KEYS} ORDER BY period_date) AS DECIMAL(24,3)) AS amount FROM summed)
    SELECT {_DIFFERENCE_KEYS}, period_date, 2 AS data_type_id, amount FROM d WHERE period_date = {PERIOD}""",
)
def month_by_difference(spark, sf_dir):
    block = base_block(stored_report_rows(spark, sf_dir)).withColumn("amount", F.col("amount").cast(PUBLISHED))
    history, current = block.where(F.col("period_date") < PERIOD), block.where(F.col("period_date") == PERIOD)
    return period_by_difference(history, current, PERIOD).drop("company_id")


@query(
    "period_difference_all",
    f"""WITH {BLOCK_CTES}, e AS (SELECT {_DIFFERENCE_KEYS}, period_date, CAST(sum(amount) AS DECIMAL(24,3)) AS ytd FROM block
      WHERE data_type_id = 1 AND currency = 'Euros' GROUP BY ALL)
    SELECT {_DIFFERENCE_KEYS}, period_date, ytd, CAST(ytd - lag(ytd, 1, 0) OVER (PARTITION BY period_date // 10000, {_DIFFERENCE_KEYS} ORDER BY period_date) AS DECIMAL(24,3)) AS month_amount FROM e""",
)
def period_difference_all(spark, sf_dir):
    """The differences of every period of every year at once."""
    euros = base_block(stored_report_rows(spark, sf_dir)).where((F.col("data_type_id") == 1) & (F.col("currency") != LOCAL))
    keyed = euros.withColumn("year", F.floor(F.col("period_date") / 10000).cast("int"))
    keys = [k.strip() for k in _DIFFERENCE_KEYS.split(",")]
    rows = difference_from_previous(keyed, ["year", *keys], "period_date", "amount", "month_amount")
    return rows.select(
        *keys, "period_date", F.col("amount").cast(PUBLISHED).alias("ytd"), F.col("month_amount").cast(PUBLISHED).alias("month_amount")
    )
