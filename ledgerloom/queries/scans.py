"""Scans, filters and projections."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.calendar import month_code
from ledgerloom.functions.columns import all_nullable, dictionary_projection, ensure_columns, typed_projection
from ledgerloom.functions.predicates import any_of, same_year, within
from ledgerloom.functions.scenarios import fact_scenario_id, select_scenarios
from ledgerloom.functions.types import MONEY
from ledgerloom.operators.reshape import pivot_sum
from ledgerloom.queries.base import MONEY_SQL, kpi_fact, money, table
from ledgerloom.queries.base import KPI_FACT_SQL
from ledgerloom.queries.registry import query
from ledgerloom.session import new_path
from ledgerloom.sources.masters import catalogue_measures, load_master
from ledgerloom.sources.sinks import overwrite_partitions
from ledgerloom.sources.snapshots import latest_load, read_latest, read_snapshot
from ledgerloom.sources.tables import literal_table, read_slice


@query(
    "scan_slice",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def scan_slice(spark, sf_dir):
    wanted = {"o_orderstatus": "F", "o_orderpriority": ["1-URGENT", "2-HIGH"]}
    rows = read_slice(spark, f"{sf_dir}/orders.parquet", wanted)
    return rows.select("o_orderkey", "o_custkey", "o_totalprice")


def _coded_orders(spark, sf_dir):
    status = {"F": "RE", "O": "PA"}
    orders = table(spark, sf_dir, "orders")
    name = F.when(F.col("o_orderstatus") == "F", status["F"]).when(F.col("o_orderstatus") == "O", status["O"]).otherwise("UPA")
    return orders.select(
        "o_orderkey", (month_code(F.col("o_orderdate")) * 100 + 1).alias("day"), name.alias("scenario"),
        "o_orderpriority", "o_totalprice",
    )


_CODED_ORDERS_SQL = """coded AS (
  SELECT o_orderkey, CAST((year(o_orderdate) * 100 + month(o_orderdate)) * 100 + 1 AS INTEGER) AS day,
         CASE o_orderstatus WHEN 'F' THEN 'RE' WHEN 'O' THEN 'PA' ELSE 'UPA' END AS scenario, o_orderpriority, o_totalprice
  FROM orders)"""


@query(
    "scenario_select",
    f"WITH {_CODED_ORDERS_SQL} SELECT CASE scenario WHEN 'PA' THEN 2 ELSE 4 END AS scenario_id, count(*) AS n, "
    "max(o_totalprice) AS top FROM coded WHERE scenario IN ('PA', 'UPA') GROUP BY 1",
)
def scenario_select(spark, sf_dir):
    coded = _coded_orders(spark, sf_dir).withColumn("scenario_id", fact_scenario_id("scenario"))
    chosen = select_scenarios(coded, "PA-UPA", "fact")
    return chosen.groupBy("scenario_id").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))


@query(
    "filter_forms",
    f"""WITH {_CODED_ORDERS_SQL} SELECT o_orderkey, day, scenario FROM coded
    WHERE ((scenario = 'RE' AND o_orderpriority IN ('1-URGENT', '5-LOW')) OR scenario = 'PA')
      AND day >= 19960101 AND day <= 19991201 AND NOT (scenario = 'PA' AND o_orderpriority = '3-MEDIUM')
      AND o_orderpriority <> '2-HIGH' AND (o_totalprice > 1000 OR o_orderpriority = '5-LOW') AND o_totalprice IS NOT NULL""",
)
def filter_forms(spark, sf_dir):
    rows = _coded_orders(spark, sf_dir)
    groups = [{"scenario": "RE", "o_orderpriority": ["1-URGENT", "5-LOW"]}, {"scenario": "PA"}]
    kept = rows.where(any_of(groups)).where(within("day", 19960101, 19991201))
    kept = kept.where(~((F.col("scenario") == "PA") & (F.col("o_orderpriority") == "3-MEDIUM")))
    kept = kept.where(F.col("o_orderpriority") != "2-HIGH").where("o_totalprice > 1000 OR o_orderpriority = '5-LOW'")
    return kept.where(F.col("o_totalprice").isNotNull()).select("o_orderkey", "day", "scenario")


@query(
    "same_year",
    f"WITH {_CODED_ORDERS_SQL} SELECT day, count(*) AS n FROM coded WHERE day // 10000 = 1998 AND day < 19980901 GROUP BY day",
)
def same_year_query(spark, sf_dir):
    rows = _coded_orders(spark, sf_dir).where(same_year("day", 19980901) & (F.col("day") < 19980901))
    return rows.groupBy("day").agg(F.count("*").alias("n"))


def _loaded_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("load_part"), month_code(F.col("o_orderdate")).alias("period")
    )


@query(
    "snapshot_latest",
    "SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS load_part FROM orders "
    "WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) AND o_totalprice >= 0.1",
)
def snapshot_latest(spark, sf_dir):
    rows = latest_load(_loaded_orders(spark, sf_dir), "load_part", "o_totalprice", 0.1)
    return rows.select("o_orderkey", "o_totalprice", "load_part")


@query(
    "snapshot_read",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1997 AND o_orderpriority = "
    "(SELECT max(o_orderpriority) FROM orders WHERE year(o_orderdate) = 1997)",
)
def snapshot_read(spark, sf_dir):
    """Orders stored in snapshots ``priority-year`` below plain folders; the greatest of a year is read."""
    path = new_path(spark, "snapshots")
    stamped = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.concat(F.translate("o_orderpriority", "-", "_"), F.lit("-"), F.year("o_orderdate").cast("string")).alias("snapshot"),
    )
    for folder, urgent in (("a_urgent", True), ("b_others", False)):
        overwrite_partitions(stamped.where(F.col("snapshot").startswith("1") == urgent), f"{path}/{folder}", ["snapshot"])
    return read_snapshot(spark, path, "snapshot", "1997").select("o_orderkey", "o_totalprice")


@query(
    "latest_load_read",
    "SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS load_part FROM orders "
    "WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)",
)
def latest_load_read(spark, sf_dir):
    path = new_path(spark, "loads")
    overwrite_partitions(_loaded_orders(spark, sf_dir).drop("period"), path, ["load_part"])
    return read_latest(spark, path, "load_part").select("o_orderkey", "o_totalprice", "load_part")


@query(
    "typed_projection",
    f"""SELECT CAST(l_orderkey AS INTEGER) AS order_id, l_returnflag AS origin, {MONEY_SQL.format("l_extendedprice")} AS value,
    CAST(CAST(l_quantity AS DECIMAL(16,2)) AS VARCHAR) AS quantity_text, 1 AS record_id FROM lineitem""",
)
def typed_projection_query(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("price", F.col("l_extendedprice").cast("decimal(18,2)"))
    lines = lines.withColumn("amount", F.col("l_quantity").cast("decimal(16,2)"))
    spec = [
        ("l_orderkey", "order_id", T.IntegerType()),
        ("l_returnflag", "origin", T.StringType()),
        ("price", "value", MONEY),
        ("amount", "quantity_text", T.StringType()),
    ]
    return typed_projection(lines, spec).withColumn("record_id", F.lit(1))


_PRIORITIES = {"1-URGENT": "m_urgent", "2-HIGH": "m_high", "5-LOW": "m_low", "9-NEVER": "m_never"}


@query(
    "label_projection",
    f"""SELECT o_orderstatus, CAST(sum({MONEY_SQL.format("o_totalprice")}) FILTER (WHERE o_orderpriority = '1-URGENT') AS DECIMAL(24,10)) AS m_urgent,
    CAST(sum({MONEY_SQL.format("o_totalprice")}) FILTER (WHERE o_orderpriority = '2-HIGH') AS DECIMAL(24,10)) AS m_high,
    CAST(sum({MONEY_SQL.format("o_totalprice")}) FILTER (WHERE o_orderpriority = '5-LOW') AS DECIMAL(24,10)) AS m_low,
    CAST(NULL AS DECIMAL(24,10)) AS m_never FROM orders GROUP BY 1""",
)
def label_projection(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("value", money(F.col("o_totalprice")))
    labels = [p for p in _PRIORITIES if p != "9-NEVER"]
    wide = pivot_sum(orders, ["o_orderstatus"], "o_orderpriority", "value", labels)
    return dictionary_projection(wide, ["o_orderstatus"], _PRIORITIES)


@query("all_nullable", "SELECT o_orderkey, o_custkey, o_orderstatus, 1 AS record_id FROM orders")
def all_nullable_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return all_nullable(orders.withColumn("record_id", F.lit(1)))


@query(
    "ensure_columns",
    f"""WITH {KPI_FACT_SQL} SELECT period, CAST(sum(value) FILTER (WHERE name = 'PROMO') AS DECIMAL(24,10)) AS "PROMO",
    CAST(sum(value) FILTER (WHERE name = 'LARGE') AS DECIMAL(24,10)) AS "LARGE", CAST(NULL AS DECIMAL(24,10)) AS "LUXURY",
    CAST(0 AS DECIMAL(24,10)) AS "FREE" FROM kpi_fact GROUP BY period""",
)
def ensure_columns_query(spark, sf_dir):
    wide = pivot_sum(kpi_fact(spark, sf_dir), ["period"], "name", "value", ["PROMO", "LARGE"])
    return ensure_columns(ensure_columns(wide, ["promo", "Large", "LUXURY"]), ["FREE", "large"], 0)


@query(
    "literal_table",
    """SELECT v.des AS label, v.code, count(*) AS n FROM part JOIN (VALUES ('SMALL', 'm_small'), ('LARGE', 'm_large'))
    AS v(des, code) ON p_type = v.des GROUP BY 1, 2""",
)
def literal_table_query(spark, sf_dir):
    labels = literal_table(spark, "label string, code string", [("SMALL", "m_small"), ("LARGE", "m_large")])
    parts = table(spark, sf_dir, "part")
    return parts.join(labels, parts.p_type == labels.label).groupBy("label", "code").agg(F.count("*").alias("n"))


@query(
    "master_load",
    """SELECT CAST(p_partkey AS INTEGER) AS concept_id, p_size AS sort_order, CAST(floor(p_retailprice) AS INTEGER) AS divisor_id,
    p_name AS concept, '2024-01-01 0' || p_size || ':00' AS loaded_at FROM part""",
)
def master_load(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn(
        "stamp", F.concat(F.lit("2024-01-01T0"), F.col("p_size").cast("string"), F.lit(":00"))
    )
    parts = parts.withColumn("price", F.floor("p_retailprice"))
    spec = [
        ("p_partkey", "concept_id", "int"), ("p_size", "sort_order", "int"), ("price", "divisor_id", "int"),
        ("p_name", "concept", "string"),
    ]
    return load_master(parts, spec, "stamp", "loaded_at")


def _catalogue(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return customers.select(
        F.col("c_name").alias("workspace"),
        F.array(
            F.struct(F.lit("nation").alias("name"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("dataset_id")),
            F.struct(F.lit("segment").alias("name"), F.col("c_mktsegment").alias("dataset_id")),
        ).alias("reports"),
    )


@query(
    "catalog_flatten",
    """WITH flat AS (SELECT c_name AS workspace, 'nation' AS report, 'n' || c_nationkey AS dataset FROM customer
    UNION ALL SELECT c_name, 'segment', c_mktsegment FROM customer)
    SELECT workspace, report, flat.dataset, m.measure, m.expression FROM flat LEFT JOIN
    (SELECT 'n' || n_nationkey AS dataset, n_name AS measure, 'region ' || n_regionkey AS expression FROM nation) AS m
    ON m.dataset = flat.dataset""",
)
def catalog_flatten(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    measures = nation.select(
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("dataset"),
        F.col("n_name").alias("measure"),
        F.concat(F.lit("region "), F.col("n_regionkey").cast("string")).alias("expression"),
    )
    rows = catalogue_measures(_catalogue(spark, sf_dir), measures)
    return rows.select("workspace", "report", "dataset", "measure", "expression")
