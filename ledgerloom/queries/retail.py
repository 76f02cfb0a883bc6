"""Orders, stock and customers: parts are products, their size is the stock."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.plans.retail import (
    accepted_orders,
    add_products,
    coupon_applied,
    coupon_total,
    discounted_price,
    fulfilled_orders,
    inventory_report,
    low_stock,
    loyalty_points,
    order_by_id,
    order_totals,
    orders_of,
    remove_products,
    status_valid,
    stock_after,
    stock_left,
    validate_items,
)
from ledgerloom.queries.base import table
from ledgerloom.queries.registry import query

_PRICE = "decimal(10,2)"


def _products(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast(_PRICE).alias("price"),
        F.col("p_size").alias("stock"),
        F.col("p_type").alias("category"),
    )


def _items(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_linenumber").alias("line"),
    )


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
    )


@query(
    "discount_price",
    """WITH p AS (SELECT p_partkey AS product_id, CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_size * 4 - 20 AS percent FROM part)
    SELECT product_id, percent, CASE WHEN percent BETWEEN 0 AND 100 THEN round(CAST(price AS DOUBLE) * (1 - CAST(percent AS DOUBLE) / 100), 6) END AS reduced,
    percent BETWEEN 0 AND 100 AS valid FROM p""",
)
def discount_price(spark, sf_dir):
    """Percentages from -16 to 180, so that some are out of range."""
    rows = _products(spark, sf_dir).select("product_id", "price", (F.col("stock") * 4 - 20).alias("percent"))
    reduced = discounted_price(F.col("price").cast("double"), F.col("percent").cast("double"))
    return rows.select(
        "product_id", "percent", F.round(reduced, 6).alias("reduced"), F.col("percent").between(0, 100).alias("valid")
    )


@query(
    "order_total",
    """SELECT l_orderkey AS order_id, CAST(sum(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(l_quantity AS INTEGER)) AS DECIMAL(24,2)) AS total
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def order_total(spark, sf_dir):
    priced = _items(spark, sf_dir).join(_products(spark, sf_dir).select("product_id", "price"), "product_id")
    return order_totals(priced).withColumn("total", F.col("total").cast("decimal(24,2)"))


@query(
    "stock_after",
    """SELECT p_partkey AS product_id, p_size AS stock, CAST(p_size + coalesce(moved, 0) AS BIGINT) AS stock_after, p_size + coalesce(moved, 0) >= 0 AS covered
    FROM part LEFT JOIN (SELECT l_partkey, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE -1 END * CAST(l_quantity AS INTEGER)) AS moved FROM lineitem GROUP BY 1) AS m
    ON p_partkey = l_partkey""",
)
def stock_after_query(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    signed = F.when(F.col("l_returnflag") == "R", 1).otherwise(-1) * F.col("l_quantity").cast("int")
    movements = lines.select(F.col("l_partkey").alias("product_id"), signed.alias("quantity"))
    return stock_after(_products(spark, sf_dir), movements).select("product_id", "stock", "stock_after", "covered")


@query("low_stock", "SELECT p_partkey AS product_id, p_name AS name, p_size AS stock FROM part WHERE p_size < 10")
def low_stock_query(spark, sf_dir):
    return low_stock(_products(spark, sf_dir)).select("product_id", "name", "stock")


@query(
    "inventory_value",
    """WITH v AS (SELECT p_name AS product, p_size AS stock, CAST(CAST(p_retailprice AS DECIMAL(10,2)) * p_size AS DECIMAL(24,2)) AS value FROM part)
    SELECT product, CAST(stock AS BIGINT) AS stock, value FROM v UNION ALL SELECT 'TOTAL', CAST(sum(stock) AS BIGINT), CAST(sum(value) AS DECIMAL(24,2)) FROM v""",
)
def inventory_value(spark, sf_dir):
    report = inventory_report(_products(spark, sf_dir))
    return report.withColumns({"stock": F.col("stock").cast("bigint"), "value": F.col("value").cast("decimal(24,2)")})


_STOCK_SQL = "SELECT p_partkey, p_size FROM part WHERE p_type <> 'PROMO'"


@query(
    "order_validate",
    f"""SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line, CAST(l_quantity AS INTEGER) AS quantity,
    CASE WHEN p_partkey IS NULL THEN 'unknown product' WHEN p_size < sum(l_quantity) OVER (PARTITION BY l_orderkey, l_partkey) THEN 'insufficient stock' ELSE 'ok' END AS verdict
    FROM lineitem LEFT JOIN ({_STOCK_SQL}) AS s ON l_partkey = p_partkey""",
)
def order_validate(spark, sf_dir):
    """Promotional parts are not in the catalogue, their lines are unknown."""
    stock = _products(spark, sf_dir).where(F.col("category") != "PROMO")
    return validate_items(_items(spark, sf_dir), stock).select("order_id", "product_id", "line", "quantity", "verdict")


@query(
    "order_accept",
    f"""SELECT l_orderkey AS order_id, bool_and(p_partkey IS NOT NULL AND p_size >= wanted) AS accepted
    FROM (SELECT l_orderkey, l_partkey, sum(l_quantity) AS wanted FROM lineitem GROUP BY ALL) AS i
    LEFT JOIN ({_STOCK_SQL}) AS s ON l_partkey = p_partkey GROUP BY 1""",
)
def order_accept(spark, sf_dir):
    stock = _products(spark, sf_dir).where(F.col("category") != "PROMO")
    return accepted_orders(_items(spark, sf_dir), stock)


# Orders one after the other: what earlier accepted orders took is gone. Each step of the recursion
# decides the orders between whose demand and the stock nothing open stands.
_FULFIL_SQL = f"""WITH RECURSIVE d AS (
  SELECT l_orderkey AS o, l_partkey AS p, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS q FROM lineitem GROUP BY ALL),
s AS (SELECT d.*, p_size AS s FROM d LEFT JOIN ({_STOCK_SQL}) AS t ON d.p = t.p_partkey),
open AS (SELECT o FROM s GROUP BY o HAVING bool_and(coalesce(q <= s, false))),
steps AS (
  SELECT 0 AS step, s.o, s.p, s.q, s.s, CAST(NULL AS BOOLEAN) AS taken FROM s JOIN open USING (o)
  UNION ALL
  SELECT step + 1, o, p, q, s,
         CASE WHEN taken IS NOT NULL THEN taken
              WHEN bool_and(taken IS NULL AND q <= s - more) OVER (PARTITION BY o) THEN true
              WHEN bool_or(q > s - less) OVER (PARTITION BY o) THEN false END
  FROM (SELECT *, coalesce(sum(CASE WHEN coalesce(taken, true) THEN q ELSE 0 END) OVER w, 0) AS more,
               coalesce(sum(CASE WHEN taken THEN q ELSE 0 END) OVER w, 0) AS less
        FROM (SELECT *, count(*) FILTER (WHERE taken IS NULL) OVER () AS undecided FROM steps)
        WHERE undecided > 0
        WINDOW w AS (PARTITION BY p ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))),
last AS (SELECT DISTINCT o, taken FROM steps WHERE step = (SELECT max(step) FROM steps)),
orders AS (SELECT DISTINCT d.o AS order_id, coalesce(taken, false) AS accepted FROM d LEFT JOIN last USING (o))"""


@query("order_fulfil", f"{_FULFIL_SQL} SELECT order_id, accepted FROM orders")
def order_fulfil(spark, sf_dir):
    """Accepted orders use up the stock that later ones find."""
    stock = _products(spark, sf_dir).where(F.col("category") != "PROMO")
    return fulfilled_orders(_items(spark, sf_dir), stock)


@query(
    "stock_left",
    f"""{_FULFIL_SQL} SELECT p_partkey AS product_id, p_size AS stock, CAST(p_size - coalesce(q, 0) AS BIGINT) AS "left"
    FROM ({_STOCK_SQL}) AS t LEFT JOIN (SELECT p, sum(q) AS q FROM d JOIN orders ON o = order_id WHERE accepted GROUP BY p) AS m ON p_partkey = p""",
)
def stock_left_query(spark, sf_dir):
    stock = _products(spark, sf_dir).where(F.col("category") != "PROMO")
    items = _items(spark, sf_dir)
    return stock_left(items, stock, fulfilled_orders(items, stock)).select("product_id", "stock", "left")


@query(
    "loyalty_points",
    "SELECT o_custkey AS customer_id, CAST(sum(CAST(floor(CAST(o_totalprice AS DECIMAL(18,2)) / 10) AS BIGINT)) AS BIGINT) AS points FROM orders GROUP BY 1",
)
def loyalty_points_query(spark, sf_dir):
    return loyalty_points(_orders(spark, sf_dir)).withColumn("points", F.col("points").cast("bigint"))


_STATUS = {"F": "delivered", "O": "pending", "P": "lost"}


@query(
    "status_check",
    """SELECT o_orderkey AS order_id, CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'pending' ELSE 'lost' END AS status,
    o_orderstatus IN ('F', 'O') AS valid FROM orders""",
)
def status_check(spark, sf_dir):
    status = F.when(F.col("status") == "F", _STATUS["F"]).when(F.col("status") == "O", _STATUS["O"]).otherwise(_STATUS["P"])
    rows = _orders(spark, sf_dir).select("order_id", status.alias("status"))
    return rows.withColumn("valid", status_valid("status"))


@query(
    "coupon",
    """SELECT o_orderkey AS order_id, round(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice - o_totalprice * (12.5 / 100) ELSE o_totalprice END, 6) AS total, o_orderpriority = '1-URGENT' AS applied FROM orders""",
)
def coupon(spark, sf_dir):
    code = F.when(F.col("priority") == "1-URGENT", "WELCOME10").otherwise("NONE")
    rows = _orders(spark, sf_dir).withColumns({"code": code, "total": F.col("total").cast("double")})
    reduced = coupon_total("total", "code", F.lit(12.5))
    return rows.select("order_id", F.round(reduced, 6).alias("total"), coupon_applied("code").alias("applied"))


@query(
    "customer_orders",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, 'customer' AS found_by FROM orders WHERE o_custkey = 7
    UNION ALL SELECT o_orderkey, o_custkey, 'order' FROM orders WHERE o_orderkey = 11""",
)
def customer_orders(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("order_id", "customer_id")
    by_customer = orders_of(orders, 7).withColumn("found_by", F.lit("customer"))
    return by_customer.unionByName(order_by_id(orders, 11).withColumn("found_by", F.lit("order")))


@query(
    "product_upsert",
    """SELECT p_partkey AS product_id, p_name AS name, CASE WHEN p_type = 'PROMO' THEN 0 ELSE p_size END AS stock FROM part WHERE p_type <> 'SMALL'""",
)
def product_upsert(spark, sf_dir):
    """New products are the promotional ones, offered together with known ones; small ones go."""
    products = _products(spark, sf_dir).select("product_id", "name", "stock", "category")
    known = products.where(F.col("category") != "PROMO")
    offered = products.where(F.col("category").isin("PROMO", "LARGE")).withColumn("stock", F.lit(0))
    removed = products.where(F.col("category") == "SMALL")
    return remove_products(add_products(known, offered), removed).select("product_id", "name", "stock")
