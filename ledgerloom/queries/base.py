"""Views the queries start from, in Spark and in SQL.

``kpi_fact`` stands for the KPI masters: one row per order line with a period, a scenario, the
three parts of the KPI label and an amount.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.calendar import first_day, month_code, year_of_month
from ledgerloom.functions.columns import dictionary_projection
from ledgerloom.functions.scenarios import fact_scenario_id
from ledgerloom.functions.types import MONEY
from ledgerloom.operators.reshape import pivot_sum
from ledgerloom.plans.reports import MAPPING_SCHEMA, report_rows
from ledgerloom.session import cut_lineage
from ledgerloom.sources.tables import literal_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column) -> F.Column:
    """Two-decimal double to the money type."""
    return column.cast("decimal(18,2)").cast(MONEY)


MONEY_SQL = "CAST(CAST({} AS DECIMAL(18,2)) AS DECIMAL(24,10))"


def scenario_name(status="o_orderstatus", line="l_linestatus"):
    return (
        F.when(F.col(status) == "F", "RE")
        .when(F.col(status) == "O", "PA")
        .when(F.col(line) == "F", "UPA")
        .otherwise("EST")
    )


def kpi_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        parts, lines.l_partkey == parts.p_partkey
    )
    return joined.select(
        month_code(F.col("o_orderdate")).alias("period"),
        scenario_name().alias("scenario"),
        F.col("p_brand").alias("unit"),
        F.col("p_type").alias("name"),
        F.when(F.col("p_size") >= 8, F.col("p_name")).alias("product"),
        money(F.col("l_extendedprice")).alias("value"),
    )


KPI_FACT_SQL = f"""kpi_fact AS (
  SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period,
         CASE WHEN o_orderstatus = 'F' THEN 'RE' WHEN o_orderstatus = 'O' THEN 'PA'
              WHEN l_linestatus = 'F' THEN 'UPA' ELSE 'EST' END AS scenario,
         p_brand AS unit, p_type AS name,
         CASE WHEN p_size >= 8 THEN p_name END AS product,
         {MONEY_SQL.format("l_extendedprice")} AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

# Scenario ids of the two stages as SQL.
FACT_ID_SQL = "CASE {0} WHEN 'RE' THEN 3 WHEN 'PA' THEN 2 WHEN 'UPA' THEN 4 ELSE 1 END"
RESTAGE_SQL = "CASE {0} WHEN 3 THEN 1 WHEN 2 THEN 2 WHEN 4 THEN 3 WHEN 1 THEN 4 END"

# Labels of the pivot and the metric they become; the last label never occurs in the data.
LABELS = {
    "ECONOMY": "m_economy",
    "SMALL": "m_small",
    "STANDARD": "m_standard",
    "MEDIUM": "m_medium",
    "PROMO": "m_promo",
    "LARGE": "m_large",
    "LUXURY": "m_luxury",
}
METRICS = list(LABELS.values())

# Exchange rates per year: (year, monthly rate, rate accumulated over the year).
RATES = [
    (1995, "8.1327", "8.0713"),
    (1996, "9.4719", "9.3307"),
    (1997, "8.9141", "8.8673"),
    (1998, "10.2357", "10.1129"),
    (1999, "10.1893", "10.0437"),
    (2000, "8.7219", "8.6931"),
    (2001, "8.3411", "8.2903"),
]


def rates(spark: SparkSession) -> DataFrame:
    rows = [(y, Decimal(m), Decimal(a)) for y, m, a in RATES]
    return literal_table(spark, "year int, rate_month decimal(24,10), rate_acc decimal(24,10)", rows)


RATES_SQL = (
    "rates AS (SELECT year, CAST(m AS DECIMAL(24,10)) AS rate_month, CAST(a AS DECIMAL(24,10)) AS rate_acc FROM (VALUES "
    + ", ".join(f"({y}, '{m}', '{a}')" for y, m, a in RATES)
    + ") AS v(year, m, a))"
)


def wide_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (period_date, scenario_id) with the metrics and the two rates of its year."""
    fact = kpi_fact(spark, sf_dir)
    coded = fact.select("period", fact_scenario_id("scenario").alias("scenario_id"), "name", "value")
    wide = pivot_sum(coded, ["period", "scenario_id"], "name", "value", [n for n in LABELS if n != "LUXURY"])
    named = dictionary_projection(wide, ["period", "scenario_id"], LABELS)
    rated = named.withColumn("year", year_of_month(F.col("period"))).join(rates(spark), "year", "left")
    return rated.select(first_day(F.col("period")).alias("period_date"), "scenario_id", *METRICS, "rate_month", "rate_acc")


WIDE_SQL = (
    "wide AS (SELECT period_date, scenario_id, "
    + ", ".join(METRICS)
    + ", rate_month, rate_acc FROM (SELECT CAST(period * 100 + 1 AS INTEGER) AS period_date, period // 100 AS year, "
    + FACT_ID_SQL.format("scenario")
    + " AS scenario_id, "
    + ", ".join(
        f"CAST(sum(value) FILTER (WHERE name = '{label}') AS DECIMAL(24,10)) AS {code}" for label, code in LABELS.items()
    )
    + " FROM kpi_fact GROUP BY 1, 2, 3) AS w LEFT JOIN rates USING (year))"
)
WIDE_CTES = f"{KPI_FACT_SQL}, {RATES_SQL}, {WIDE_SQL}"


def mapping_rows() -> list[tuple]:
    """Report rows each metric feeds; estimates and updated budgets feed a subset."""
    rows = []
    for scenario in (3, 2, 4, 1):
        rows.append((scenario, "rate_month", 13, 1, "B1", None, None))
        rows.append((scenario, "m_small", 13, 2, "B1", 1, None))
        for position, metric in enumerate(METRICS):
            rows.append((scenario, metric, 13, 30 + position, "B1", 1, position))
            if scenario in (3, 2):
                rows.append((scenario, metric, 12, 40 + position, "B2", 2, position))
        rows.append((scenario, "m_large", 12, 28, "B2", None, 7))
        rows.append((scenario, "m_medium", 12, None, "B2", 3, 7))
    return rows


REPORT_METRICS = [*METRICS, "rate_month"]


def mapping(spark: SparkSession) -> DataFrame:
    return literal_table(spark, MAPPING_SCHEMA, mapping_rows())


def _sql_value(value) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else str(value)


MAPPING_SQL = (
    "mapping AS (SELECT CAST(s AS INTEGER) AS scenario_id, m AS metric, CAST(r AS INTEGER) AS report_id, "
    "CAST(c AS INTEGER) AS concept_id, b AS business_id, CAST(d1 AS INTEGER) AS dim1_id, CAST(d2 AS INTEGER) AS dim2_id FROM (VALUES "
    + ", ".join("(" + ", ".join(_sql_value(v) for v in row) + ")" for row in mapping_rows())
    + ") AS v(s, m, r, c, b, d1, d2))"
)


def base_report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report rows of all periods, in the local currency."""
    return report_rows(wide_metrics(spark, sf_dir), mapping(spark), REPORT_METRICS, "rate_acc", "rate_month")


def stored_report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows materialised once, for queries with several branches over them.

    They are few whatever the size of the fact, and filters of the branches would otherwise keep
    Spark from sharing the joins below them.
    """
    return cut_lineage(base_report_rows(spark, sf_dir))


REPORT_ROWS_SQL = f"""long AS (
  SELECT period_date, scenario_id, rate_month AS fx_month, rate_acc AS fx_acc, metric, amount
  FROM ({" UNION ALL ".join(f"SELECT *, '{m}' AS metric, {m} AS amount FROM wide" for m in REPORT_METRICS)}) AS u
  WHERE amount IS NOT NULL),
report_rows AS (
  SELECT report_id, concept_id, business_id, CAST(NULL AS INTEGER) AS company_id, 2 AS data_type_id, dim1_id, dim2_id,
         {RESTAGE_SQL.format("scenario_id")} AS scenario_id,
         CAST(amount AS DECIMAL(24,3)) AS amount,
         CASE WHEN scenario_id = 4 THEN fx_month ELSE fx_acc END AS rate_acc, fx_month AS rate_month,
         'Pesos' AS currency, period_date, metric
  FROM long JOIN mapping USING (scenario_id, metric))"""
REPORT_CTES = f"{WIDE_CTES}, {MAPPING_SQL}, {REPORT_ROWS_SQL}"


def sql_reporting_amount(amount: str, rate: str) -> str:
    """Exact SQL for amount / rate / 1000 as Spark's decimals give it: half up at seven places.

    SQL engines that divide decimals as doubles would round differently, so the quotient is taken
    over integers.
    """
    n = f"CAST({amount} * 1000 AS HUGEINT)"
    d = f"CAST({rate} * 10000000000 AS HUGEINT)"
    quotient = f"((2 * abs({n}) * CAST(100000000000000 AS HUGEINT) + {d}) // (2 * {d}))"
    signed = f"(CASE WHEN {amount} < 0 THEN -1 ELSE 1 END) * {quotient}"
    return f"CAST(CAST({signed} AS DECIMAL(28,0)) * CAST('0.0000000001' AS DECIMAL(10,10)) AS DECIMAL(24,10))"
