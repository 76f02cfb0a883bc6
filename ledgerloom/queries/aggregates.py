"""Aggregates, duplicates, reshaping, numbering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.calendar import month_code
from ledgerloom.functions.scenarios import fact_scenario_id
from ledgerloom.functions.types import MONEY
from ledgerloom.operators.aggregates import group_sum, has_data, only_if, reconcile_counts
from ledgerloom.operators.dedup import dedup_rows, dedup_subset
from ledgerloom.operators.numbering import number_rows
from ledgerloom.operators.reshape import pivot_back, pivot_sum, transpose, unpivot_pair, unpivot_tagged
from ledgerloom.operators.setops import union_by_name, union_distinct, union_positional
from ledgerloom.queries.base import (
    FACT_ID_SQL,
    KPI_FACT_SQL,
    MAPPING_SQL,
    METRICS,
    MONEY_SQL,
    WIDE_CTES,
    kpi_fact,
    mapping,
    money,
    table,
    wide_metrics,
)
from ledgerloom.queries.registry import query
from ledgerloom.sources.tables import neutral_table, typed_empty


@query(
    "group_sum",
    f"WITH {KPI_FACT_SQL} SELECT period, scenario, unit, name, CAST(sum(value) AS DECIMAL(24,10)) AS value FROM kpi_fact GROUP BY ALL",
)
def group_sum_query(spark, sf_dir):
    summed = group_sum(kpi_fact(spark, sf_dir), ["period", "scenario", "unit", "name"], "value")
    return summed.withColumn("value", F.col("value").cast(MONEY))


@query(
    "pivot_sum",
    f"""WITH p AS (SELECT o_orderstatus AS status, nullif(o_orderpriority, '4-NOT SPECIFIED') AS label, {MONEY_SQL.format("o_totalprice")} AS value FROM orders)
    SELECT status, CAST(sum(value) FILTER (WHERE label = '1-URGENT') AS DECIMAL(24,10)) AS "1-URGENT",
    CAST(sum(value) FILTER (WHERE label = '5-LOW') AS DECIMAL(24,10)) AS "5-LOW",
    CAST(sum(value) FILTER (WHERE label IS NULL) AS DECIMAL(24,10)) AS "null" FROM p GROUP BY status""",
)
def pivot_sum_query(spark, sf_dir):
    label = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("status"), label.alias("label"), money(F.col("o_totalprice")).alias("value")
    )
    return pivot_sum(orders, ["status"], "label", "value", ["1-URGENT", "5-LOW", "null"])


@query(
    "global_max",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)",
)
def global_max(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    latest = orders.agg(F.max("o_orderdate")).scalar()
    return orders.where(F.col("o_orderdate") == latest).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "literal_sum",
    "SELECT CAST(sum(l_linenumber) AS BIGINT) AS total, count(*) AS n FROM lineitem",
)
def literal_sum(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.sum("l_linenumber").alias("total"), F.count("*").alias("n"))


@query(
    "has_data_guard",
    "SELECT o_orderkey, o_totalprice, 'kept' AS reason FROM orders WHERE o_orderstatus = 'F'",
)
def has_data_guard(spark, sf_dir):
    """Real orders are kept because budget orders exist; updated ones go, as no order has status X."""
    orders = table(spark, sf_dir, "orders")
    present = has_data(orders.where(F.col("o_orderstatus") == "O"), "o_totalprice")
    absent = has_data(orders.where(F.col("o_orderstatus") == "X"), "o_totalprice")
    real = only_if(orders.where(F.col("o_orderstatus") == "F"), present).withColumn("reason", F.lit("kept"))
    updated = only_if(orders.where(F.col("o_orderstatus") == "P"), absent).withColumn("reason", F.lit("unexpected"))
    return real.unionByName(updated).select("o_orderkey", "o_totalprice", "reason")


@query(
    "count_reconcile",
    """WITH w AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
    SELECT (SELECT count(*) FROM lineitem) AS rows_read, (SELECT count(*) FROM w) AS rows_written,
    (SELECT count(*) FROM lineitem) = (SELECT count(*) FROM w) AS agree""",
)
def count_reconcile(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return reconcile_counts(lines, lines.select("l_orderkey", "l_linenumber").distinct())


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_suppkey").distinct()


@query(
    "dedup_rows",
    f"WITH {KPI_FACT_SQL} SELECT DISTINCT scenario, unit, name, product FROM kpi_fact",
)
def dedup_rows_query(spark, sf_dir):
    return dedup_rows(kpi_fact(spark, sf_dir).select("scenario", "unit", "name", "product"))


@query(
    "dedup_subset",
    f"""WITH {KPI_FACT_SQL} SELECT period, scenario, unit, name, product, value FROM (SELECT *, row_number() OVER
    (PARTITION BY period, scenario, unit ORDER BY name NULLS FIRST, product NULLS FIRST, value NULLS FIRST) AS rn FROM kpi_fact) AS d WHERE rn = 1""",
)
def dedup_subset_query(spark, sf_dir):
    return dedup_subset(kpi_fact(spark, sf_dir), ["period", "scenario", "unit"])


@query(
    "unpivot_tagged",
    f"""WITH {WIDE_CTES}, {MAPPING_SQL}, u AS ({" UNION ALL ".join(f"SELECT period_date, scenario_id, '{m}' AS metric, {m} AS amount FROM wide" for m in METRICS)})
    SELECT period_date, scenario_id, metric, amount, report_id, concept_id, business_id, dim1_id, dim2_id
    FROM u JOIN mapping USING (scenario_id, metric) WHERE amount IS NOT NULL""",
)
def unpivot_tagged_query(spark, sf_dir):
    wide = wide_metrics(spark, sf_dir)
    return unpivot_tagged(wide, ["period_date", "scenario_id"], METRICS, mapping(spark), ["scenario_id", "metric"])


@query(
    "unpivot_two",
    f"""SELECT o_orderkey, 2 AS data_type_id, {MONEY_SQL.format("o_totalprice")} AS amount FROM orders
    UNION ALL SELECT o_orderkey, 1, CAST({MONEY_SQL.format("o_totalprice")} * 2 AS DECIMAL(24,10)) FROM orders""",
)
def unpivot_two(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", money(F.col("o_totalprice")).alias("one"))
    both = orders.withColumn("two", (F.col("one") * 2).cast(MONEY))
    return unpivot_pair(both, ["o_orderkey"], [("one", 2), ("two", 1)], "data_type_id", "amount")


@query(
    "transpose_roundtrip",
    "SELECT p_partkey, CAST(p_size AS DOUBLE) * 2 AS p_size, p_retailprice * 2 AS p_retailprice FROM part",
)
def transpose_roundtrip(spark, sf_dir):
    attributes = ["p_size", "p_retailprice"]
    long = transpose(table(spark, sf_dir, "part"), ["p_partkey"], attributes)
    return pivot_back(long.withColumn("value", F.col("value") * 2), ["p_partkey"], attributes)


@query(
    "row_number_global",
    "SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS position FROM customer",
)
def row_number_global(spark, sf_dir):
    numbered = number_rows(table(spark, sf_dir, "customer"), ["c_acctbal", "c_custkey"], "position")
    return numbered.select("c_custkey", "c_name", "position")


@query(
    "row_number_per_year",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, row_number() OVER (PARTITION BY year(o_orderdate)
    ORDER BY o_orderdate, o_orderkey) AS position FROM orders""",
)
def row_number_per_year(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), "o_orderdate")
    numbered = number_rows(orders, ["o_orderdate", "o_orderkey"], "position", partition_by=["year"])
    return numbered.select("o_orderkey", "year", "position")


@query(
    "union_positional",
    "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def union_positional_query(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return union_positional(customers, table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"))


@query(
    "union_by_name",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
)
def union_by_name_query(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")
    )
    return union_by_name(neutral_table(spark), customers, suppliers)


@query(
    "union_distinct",
    "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier",
)
def union_distinct_query(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    return union_distinct(customers, table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation")))


@query(
    "limit_empty",
    "SELECT p_partkey, p_name FROM part",
)
def limit_empty(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return union_by_name(typed_empty(parts), parts)


@query(
    "limit_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
)
def limit_rows(spark, sf_dir):
    """The largest orders: the limit is the feature, and its order makes the rows definite."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query(
    "fact_totals",
    f"""WITH {KPI_FACT_SQL} SELECT {FACT_ID_SQL.format("scenario")} AS scenario_id, count(*) AS n, CAST(sum(value) AS DECIMAL(24,10)) AS total,
    max(period) AS last_period FROM kpi_fact GROUP BY 1""",
)
def fact_totals(spark, sf_dir):
    fact = kpi_fact(spark, sf_dir).withColumn("scenario_id", fact_scenario_id("scenario"))
    return fact.groupBy("scenario_id").agg(
        F.count("*").alias("n"), F.sum("value").cast(MONEY).alias("total"), F.max("period").alias("last_period")
    )


@query(
    "monthly_orders",
    f"""SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period, o_orderstatus AS status,
    CAST(sum({MONEY_SQL.format("o_totalprice")}) AS DECIMAL(24,10)) AS value FROM orders GROUP BY 1, 2""",
)
def monthly_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        month_code(F.col("o_orderdate")).alias("period"), F.col("o_orderstatus").alias("status"),
        money(F.col("o_totalprice")).alias("value"),
    )
    return group_sum(orders, ["period", "status"], "value").withColumn("value", F.col("value").cast(MONEY))
