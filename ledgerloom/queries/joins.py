"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.calendar import month_code
from ledgerloom.functions.scalars import composite_label, strip_pattern
from ledgerloom.functions.types import MONEY
from ledgerloom.operators.aggregates import group_sum
from ledgerloom.operators.joins import (
    anti_join_trimmed,
    attach_scalar,
    computed_key_join,
    full_outer_left_keys,
    map_join,
    spine_join,
)
from ledgerloom.queries.base import (
    KPI_FACT_SQL,
    LABELS,
    MONEY_SQL,
    RATES_SQL,
    kpi_fact,
    money,
    rates,
    table,
)
from ledgerloom.queries.registry import query
from ledgerloom.sources.tables import literal_table


@query(
    "fact_dim_inner",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, regexp_replace(p_brand || '_' || p_type, 'Brand.', '', 'g') AS label,
    {MONEY_SQL.format("l_extendedprice")} AS value FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def fact_dim_inner(spark, sf_dir):
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey)
    label = strip_pattern(F.concat("p_brand", F.lit("_"), "p_type"), "Brand.")
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", label.alias("label"), money(F.col("l_extendedprice")).alias("value")
    )


@query(
    "left_computed_key",
    """WITH dim AS (SELECT p_brand || '_' || p_type || p_name AS label, min(p_partkey) AS id FROM part WHERE p_size >= 20 GROUP BY 1)
    SELECT p_partkey, dim.label AS label, dim.id AS id FROM part LEFT JOIN dim
    ON p_brand || '_' || p_type || coalesce(CASE WHEN p_size >= 8 THEN p_name END, '') = dim.label""",
)
def left_computed_key(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    full = composite_label("p_brand", "p_type", "p_name")
    dimension = parts.where(F.col("p_size") >= 20).groupBy(full.alias("label")).agg(F.min("p_partkey").alias("id"))
    label = composite_label("p_brand", "p_type", F.when(F.col("p_size") >= 8, F.col("p_name")))
    return computed_key_join(parts, dimension, label, "label").select("p_partkey", "label", "id")


@query(
    "anti_trim",
    """SELECT ' ' || c_name AS label, c_nationkey AS nation FROM customer WHERE NOT EXISTS
    (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND year(o_orderdate) = 1995)""",
)
def anti_trim(spark, sf_dir):
    customers, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    early = orders.where((F.col("o_orderstatus") == "F") & (F.year("o_orderdate") == 1995)).select("o_custkey").distinct()
    served = customers.join(early, customers.c_custkey == early.o_custkey)
    present = served.select(F.concat("c_name", F.lit("  ")).alias("label"))
    left = customers.select(F.concat(F.lit(" "), "c_name").alias("label"), F.col("c_nationkey").alias("nation"))
    return anti_join_trimmed(left, present, "label")


@query(
    "left_two_keys",
    f"""WITH {RATES_SQL}, o AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS status FROM orders),
    r AS (SELECT year, 'F' AS status, rate_month FROM rates)
    SELECT o.o_orderkey, o.year, o.status, r.rate_month FROM o LEFT JOIN r ON o.year = r.year AND o.status = r.status""",
)
def left_two_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("status")
    )
    known = rates(spark).select("year", F.lit("F").alias("status"), "rate_month")
    return orders.join(known, ["year", "status"], "left").select("o_orderkey", "year", "status", "rate_month")


def _amounts(spark, sf_dir, real, name):
    """Order amounts with their month; budgets are those of the year to come."""
    orders = table(spark, sf_dir, "orders").where((F.col("o_orderstatus") == "F") == real)
    month = month_code(F.col("o_orderdate"))
    period = month if real else month + 100
    key = [period.cast("int").alias("period"), F.col("o_custkey").alias("customer")]
    return orders.select(*key, F.col("o_orderkey").alias(f"{name}_order"), money(F.col("o_totalprice")).alias(name))


_AMOUNTS_SQL = (
    "SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) + {2} AS INTEGER) AS period, o_custkey AS customer, o_orderkey AS {0}_order, "
    + MONEY_SQL.format("o_totalprice")
    + " AS {0} FROM orders WHERE (o_orderstatus = 'F') = {1}"
)


@query(
    "full_outer",
    f"""WITH a AS ({_AMOUNTS_SQL.format("real", "true", 0)}), b AS ({_AMOUNTS_SQL.format("budget", "false", 100)})
    SELECT a.period, a.customer, a.real_order, a.real, b.budget_order, b.budget FROM a FULL OUTER JOIN b ON a.period = b.period AND a.customer = b.customer""",
)
def full_outer(spark, sf_dir):
    """All orders of all years, ungrouped: real amounts beside the budgets of the same customer and month."""
    budget = _amounts(spark, sf_dir, False, "budget").withColumnsRenamed({"period": "b_period", "customer": "b_customer"})
    return full_outer_left_keys(_amounts(spark, sf_dir, True, "real"), budget, {"period": "b_period", "customer": "b_customer"})


@query(
    "scalar_cross",
    """WITH rate AS (SELECT round_even(CAST(max(l_tax) * 100 AS DECIMAL(10,4)) + CAST(10.125 AS DECIMAL(10,4)), 2) AS rate FROM lineitem)
    SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(rate AS DECIMAL(10,2)) AS DECIMAL(24,4)) AS valued FROM orders, rate""",
)
def scalar_cross(spark, sf_dir):
    top = (F.max("l_tax") * 100).cast("decimal(10,4)") + F.lit("10.125").cast("decimal(10,4)")
    rate = table(spark, sf_dir, "lineitem").agg(F.bround(top, 2).cast("decimal(10,2)").alias("rate"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("total"))
    valued = attach_scalar(orders, rate, "rate")
    return valued.select("o_orderkey", (F.col("total") * F.col("rate")).cast("decimal(24,4)").alias("valued"))


@query(
    "spine_join",
    """WITH spine AS (SELECT * FROM (VALUES ('F'), ('O'), ('P'), ('X')) AS s(status)),
    d AS (SELECT o_orderstatus, o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY 1, 2)
    SELECT status, priority, n FROM spine LEFT JOIN d ON status = o_orderstatus""",
)
def spine_join_query(spark, sf_dir):
    spine = literal_table(spark, "status string", [("F",), ("O",), ("P",), ("X",)])
    counts = table(spark, sf_dir, "orders").groupBy("o_orderstatus", F.col("o_orderpriority").alias("priority"))
    return spine_join(spine, counts.agg(F.count("*").alias("n")), {"status": "o_orderstatus"})


def _labels(spark):
    return literal_table(spark, "des string, code string", list(LABELS.items()))


_LABELS_SQL = "labels_dict AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in LABELS.items()) + ") AS v(des, code))"


@query(
    "dict_join",
    f"WITH {KPI_FACT_SQL}, {_LABELS_SQL} SELECT DISTINCT code, scenario, unit FROM labels_dict LEFT JOIN kpi_fact ON des = name",
)
def dict_join(spark, sf_dir):
    """Fan-out of the dictionary; copies of a label are merged before the join."""
    seen = kpi_fact(spark, sf_dir).select("name", "scenario", "unit").distinct()
    labels = _labels(spark)
    return labels.join(seen, labels.des == seen.name, "left").select("code", "scenario", "unit").distinct()


@query(
    "map_join",
    """SELECT s_suppkey, s_name, n_name, n_regionkey FROM supplier LEFT JOIN
    (SELECT * FROM nation WHERE n_regionkey <> 3) AS n ON s_nationkey = n_nationkey""",
)
def map_join_query(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").where(F.col("n_regionkey") != 3)
    joined = map_join(table(spark, sf_dir, "supplier"), nation, {"s_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"])
    return joined.select("s_suppkey", "s_name", "n_name", "n_regionkey")


@query(
    "fanout_join",
    """SELECT n_name, s_name, s_acctbal FROM nation JOIN supplier ON n_nationkey = s_nationkey WHERE n_regionkey = 1 OR s_acctbal > 0""",
)
def fanout_join(spark, sf_dir):
    nation, supplier = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    joined = map_join(nation, supplier, {"n_nationkey": "s_nationkey"}, ["s_name", "s_acctbal"], "inner")
    return joined.where("n_regionkey = 1 OR s_acctbal > 0").select("n_name", "s_name", "s_acctbal")
