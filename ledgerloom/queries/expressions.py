"""Scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.calendar import first_day, month_code, year_of_day, year_of_month
from ledgerloom.functions.scalars import (
    adjusted,
    adjustment,
    clean_unit,
    code_of,
    composite_label,
    iso_to_blank,
    null_text,
    null_to_zero,
    safe_ratio,
    signed_sum,
    strip_pattern,
)
from ledgerloom.functions.scenarios import fact_scenario_id
from ledgerloom.functions.types import MONEY
from ledgerloom.queries.base import FACT_ID_SQL, MONEY_SQL, WIDE_CTES, money, scenario_name, table, wide_metrics
from ledgerloom.queries.registry import query


@query(
    "case_codes",
    f"""SELECT o_orderkey, {FACT_ID_SQL.format("CASE o_orderstatus WHEN 'F' THEN 'RE' WHEN 'O' THEN 'PA' ELSE 'XX' END")} AS scenario_id,
    CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 6 END AS process_id FROM orders""",
)
def case_codes(spark, sf_dir):
    name = F.when(F.col("o_orderstatus") == "F", "RE").when(F.col("o_orderstatus") == "O", "PA").otherwise("XX")
    codes = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", fact_scenario_id(name).alias("scenario_id"), code_of("o_orderpriority", codes, 6).alias("process_id")
    )


@query(
    "text_clean",
    """SELECT p_partkey, regexp_replace(replace(p_brand, '#', ','), ',', '.', 'g') AS unit,
    regexp_replace('Brand. ' || p_name, 'Brand.', '', 'g') AS label, translate('2024T' || p_type, 'T', ' ') AS stamp,
    trim('  ' || p_name || ' ') AS trimmed, substring(p_brand, 1, 4) AS start FROM part""",
)
def text_clean(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        clean_unit(F.translate("p_brand", "#", ",")).alias("unit"),
        strip_pattern(F.concat(F.lit("Brand. "), "p_name"), "Brand.").alias("label"),
        iso_to_blank(F.concat(F.lit("2024T"), "p_type")).alias("stamp"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        F.substring("p_brand", 1, 4).alias("start"),
    )


@query(
    "composite_key",
    """SELECT p_partkey, p_brand || '_' || CASE WHEN p_size < 45 THEN p_type END
    || coalesce(CASE WHEN p_size >= 8 THEN p_name END, '') AS label FROM part""",
)
def composite_key(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    label = composite_label(
        "p_brand", F.when(F.col("p_size") < 45, F.col("p_type")), F.when(F.col("p_size") >= 8, F.col("p_name"))
    )
    return parts.select("p_partkey", label.alias("label"))


@query(
    "bankers_round",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(round_even(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(24,10)) * CAST(0.05 AS DECIMAL(4,2)), 2) AS DECIMAL(24,10)) AS half
    FROM lineitem""",
)
def bankers_round(spark, sf_dir):
    value = (money(F.col("l_extendedprice")) * F.lit("0.05").cast("decimal(4,2)")).cast(MONEY)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.bround(value, 2).cast(MONEY).alias("half")
    )


@query(
    "null_text",
    "SELECT c_custkey, nullif(CASE WHEN c_mktsegment = 'BUILDING' THEN 'NULL' ELSE c_mktsegment END, 'NULL') AS segment FROM customer",
)
def null_text_query(spark, sf_dir):
    marked = F.when(F.col("c_mktsegment") == "BUILDING", "NULL").otherwise(F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", null_text(marked).alias("segment"))


@query(
    "text_to_int",
    """SELECT p_partkey, TRY_CAST(CASE WHEN p_type = 'PROMO' THEN '' WHEN p_type = 'SMALL' THEN p_name
    ELSE CAST(p_size AS VARCHAR) END AS INTEGER) AS company_id, CAST(p_size AS DECIMAL(16,2)) AS size FROM part""",
)
def text_to_int(spark, sf_dir):
    text = F.when(F.col("p_type") == "PROMO", "").when(F.col("p_type") == "SMALL", F.col("p_name"))
    text = text.otherwise(F.col("p_size").cast("string"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.try_cast("int").alias("company_id"), F.col("p_size").cast("decimal(16,2)").alias("size")
    )


@query(
    "period_codes",
    """WITH p AS (SELECT o_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period FROM orders)
    SELECT o_orderkey, period, CAST(period * 100 + 1 AS INTEGER) AS day, CAST(period // 100 AS INTEGER) AS year,
    CAST(period // 100 * 10000 AS INTEGER) AS floor_day, CAST(period // 100 * 10000 + 101 AS INTEGER) AS start_day,
    CAST(period - 1 AS INTEGER) AS before FROM p""",
)
def period_codes(spark, sf_dir):
    day = first_day(F.col("period"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", month_code(F.col("o_orderdate")).alias("period"))
    year = year_of_day(day)
    return rows.select(
        "o_orderkey",
        "period",
        day.alias("day"),
        year_of_month(F.col("period")).alias("year"),
        (year * 10000).alias("floor_day"),
        (year * 10000 + 101).alias("start_day"),
        (F.col("period") - 1).alias("before"),
    )


@query(
    "null_safe_sum",
    f"""WITH {WIDE_CTES} SELECT period_date, scenario_id,
    CAST(coalesce(m_economy, 0) + coalesce(m_small, 0) + coalesce(m_luxury, 0) - coalesce(m_large, 0) AS DECIMAL(24,10)) AS net,
    coalesce(m_luxury, 0) AS luxury FROM wide""",
)
def null_safe_sum(spark, sf_dir):
    return wide_metrics(spark, sf_dir).select(
        "period_date",
        "scenario_id",
        signed_sum(["m_economy", "m_small", "m_luxury"], ["m_large"]).alias("net"),
        null_to_zero("m_luxury").alias("luxury"),
    )


@query(
    "ratio",
    f"""WITH {WIDE_CTES} SELECT period_date, scenario_id,
    round(CAST(coalesce(m_economy, 0) AS DOUBLE) / nullif(CAST(coalesce(m_small, 0) AS DOUBLE), 0), 6) AS share,
    round(CAST(coalesce(m_economy, 0) AS DOUBLE) / nullif(CAST(coalesce(m_luxury, 0) AS DOUBLE), 0), 6) AS none FROM wide""",
)
def ratio_query(spark, sf_dir):
    def published(column):
        return F.round(column.cast("double"), 6)

    return wide_metrics(spark, sf_dir).select(
        "period_date",
        "scenario_id",
        published(safe_ratio("m_economy", "m_small")).alias("share"),
        published(safe_ratio("m_economy", "m_luxury")).alias("none"),
    )


@query(
    "reconcile_adjust",
    f"""WITH {WIDE_CTES}, r AS (SELECT period_date, scenario_id, m_economy AS computed,
    CASE WHEN scenario_id <> 1 THEN m_small END AS reported FROM wide),
    a AS (SELECT *, CASE WHEN scenario_id = 3 THEN computed - reported ELSE 0 END AS difference FROM r)
    SELECT period_date, scenario_id, CAST(difference AS DECIMAL(24,10)) AS difference,
    CAST(CASE WHEN reported IS NULL THEN computed ELSE computed - difference END AS DECIMAL(24,10)) AS result FROM a""",
)
def reconcile_adjust(spark, sf_dir):
    rows = wide_metrics(spark, sf_dir).select(
        "period_date",
        "scenario_id",
        F.col("m_economy").alias("computed"),
        F.when(F.col("scenario_id") != 1, F.col("m_small")).alias("reported"),
    )
    rows = rows.withColumn("difference", adjustment("scenario_id", 3, "computed", "reported"))
    result = adjusted("computed", "reported", "difference")
    return rows.select("period_date", "scenario_id", "difference", result.alias("result"))


@query(
    "sign_flip",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_returnflag = 'R' THEN -{MONEY_SQL.format("l_extendedprice")} ELSE {MONEY_SQL.format("l_extendedprice")} END AS amount
    FROM lineitem""",
)
def sign_flip(spark, sf_dir):
    value = money(F.col("l_extendedprice"))
    amount = F.when(F.col("l_returnflag") == "R", -value).otherwise(value)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", amount.alias("amount"))


@query(
    "fx_scale",
    f"""WITH {WIDE_CTES} SELECT period_date, scenario_id, CAST(m_economy * CAST(rate_month AS DECIMAL(10,4)) AS DECIMAL(38,6)) AS valued,
    round(CAST(m_economy AS DOUBLE) / CAST(rate_acc AS DOUBLE), 4) AS reporting,
    CAST(m_economy * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(24,10)) AS thousands FROM wide""",
)
def fx_scale(spark, sf_dir):
    wide = wide_metrics(spark, sf_dir)
    return wide.select(
        "period_date",
        "scenario_id",
        (F.col("m_economy") * F.col("rate_month").cast("decimal(10,4)")).cast("decimal(38,6)").alias("valued"),
        F.round(F.try_divide(F.col("m_economy"), F.col("rate_acc")).cast("double"), 4).alias("reporting"),
        (F.col("m_economy") / 1000).cast(MONEY).alias("thousands"),
    )


@query(
    "greeting",
    "SELECT c_custkey, 'Hello, ' || c_name || '!' AS greeting, 7 AS company_id, 'MX' AS country FROM customer",
)
def greeting(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.format_string("Hello, %s!", "c_name").alias("greeting"),
        F.lit(7).alias("company_id"),
        F.lit("MX").alias("country"),
    )


@query(
    "scenario_names",
    """SELECT CASE WHEN o_orderstatus = 'F' THEN 'RE' WHEN o_orderstatus = 'O' THEN 'PA' WHEN l_linestatus = 'F' THEN 'UPA' ELSE 'EST' END AS scenario,
    count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
)
def scenario_names(spark, sf_dir):
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.groupBy(scenario_name().alias("scenario")).agg(F.count("*").alias("n"))
