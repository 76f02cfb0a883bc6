"""Orders, stock and customers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import stage_rows

# Business rules.
LOW_STOCK = 10
STATUSES = ("pending", "processing", "shipped", "delivered", "cancelled")
COUPON = "WELCOME10"
AMOUNT_PER_POINT = 10
TOTAL_LABEL = "TOTAL"
UNKNOWN, SHORT, ACCEPTED = "unknown product", "insufficient stock", "ok"


def discounted_price(price: str | Column, percent: str | Column) -> Column:
    """Price less a percentage; a percentage outside 0..100 gives null."""
    price = F.col(price) if isinstance(price, str) else price
    percent = F.col(percent) if isinstance(percent, str) else percent
    return F.when(percent.between(0, 100), price * (1 - percent / 100))


def order_totals(items: DataFrame) -> DataFrame:
    """Sum of price times quantity per order."""
    return items.groupBy("order_id").agg(F.sum(F.col("price") * F.col("quantity")).alias("total"))


def stock_after(stock: DataFrame, movements: DataFrame) -> DataFrame:
    """Stock after all movements of a product and whether it is still covered.

    Movements are summed per product before the join, so a product with very many movements is
    combined in the tasks that read it.
    """
    moved = movements.groupBy("product_id").agg(F.sum("quantity").alias("moved"))
    after = F.col("stock") + F.coalesce("moved", F.lit(0))
    joined = stock.join(moved, "product_id", "left").withColumn("stock_after", after).drop("moved")
    return joined.withColumn("covered", F.col("stock_after") >= 0)


def low_stock(stock: DataFrame, threshold: int = LOW_STOCK) -> DataFrame:
    return stock.where(F.col("stock") < threshold)


def inventory_report(stock: DataFrame) -> DataFrame:
    """Value of every product and the grand total as a row of its own."""
    valued = stock.select(F.col("name").alias("product"), "stock", (F.col("price") * F.col("stock")).alias("value"))
    total = valued.agg(F.sum("stock").alias("stock"), F.sum("value").alias("value"))
    return valued.unionByName(total.select(F.lit(TOTAL_LABEL).alias("product"), "stock", "value"))


def validate_items(items: DataFrame, stock: DataFrame) -> DataFrame:
    """Each order line with its verdict: unknown product, too little stock, or ok.

    Lines of one order draw on the same stock: their quantities are added up per product. Only
    products that an order lists more than once are joined back to its lines.
    """
    together = items.groupBy("order_id", "product_id").agg(F.sum("quantity").alias("__together"), F.count("*").alias("__lines"))
    together = together.where(F.col("__lines") > 1).drop("__lines")
    known = stock.select("product_id", "stock", F.lit(True).alias("__known"))
    wanted = F.coalesce("__together", "quantity")
    verdict = (
        F.when(F.col("__known").isNull(), UNKNOWN)
        .when(F.col("quantity").isNull() | F.coalesce(F.col("stock") < wanted, F.lit(True)), SHORT)
        .otherwise(ACCEPTED)
    )
    demand = items.join(known, "product_id", "left").join(together, ["order_id", "product_id"], "left")
    return demand.withColumn("verdict", verdict).drop("__known", "__together")


def demand(items: DataFrame) -> DataFrame:
    """(order_id, product_id, quantity): what an order wants of a product, null if a line does not say."""
    whole = F.when(F.count("quantity") == F.count("*"), F.sum("quantity"))
    return items.groupBy("order_id", "product_id").agg(whole.alias("quantity"))


def _covered(wanted: DataFrame, stock: DataFrame) -> DataFrame:
    """``wanted`` with the stock and whether it would cover this demand alone."""
    known = stock.select("product_id", F.col("stock").cast("bigint").alias("stock"))
    return wanted.join(known, "product_id", "left").withColumn("fits", F.coalesce(F.col("quantity") <= F.col("stock"), F.lit(False)))


def accepted_orders(items: DataFrame, stock: DataFrame) -> DataFrame:
    """Orders whose every product is known and covered by the stock at the start; one bad line rejects the order."""
    return _covered(demand(items), stock).groupBy("order_id").agg(F.bool_and("fits").alias("accepted"))


def fulfilled_orders(items: DataFrame, stock: DataFrame) -> DataFrame:
    """(order_id, accepted): orders taken one after the other by id, each from what earlier ones left.

    An accepted order lowers the stock, a rejected one leaves it. Two bounds replace the walk: an
    order is accepted if it fits even though all undecided earlier orders are served, and rejected if
    it does not fit even though none of them is. What then is open is looked at again; the first
    open order is always decided, so rounds end (8 for the 150,000 orders of scale 0.1). Demand is
    added up over ranges of (product, order) and over their totals, so that one product's orders are
    never in one task. An order with an unknown product or an unknown quantity is rejected; negative
    quantities are returns, which bring stock if their order is accepted. Rows without order id are
    no order.
    """
    wanted = stage_rows(_covered(demand(items.where(F.col("order_id").isNotNull())), stock), "demand")
    # An order may still fit after returns; without returns what exceeds the start is rejected at once.
    back = wanted.where(F.col("quantity") < 0).groupBy("product_id").agg((-F.sum("quantity")).alias("back"))
    may = F.coalesce(F.col("quantity") <= F.col("stock") + F.coalesce("back", F.lit(0)), F.lit(False))
    first = wanted.join(back, "product_id", "left").groupBy("order_id").agg(F.bool_and(may).alias("open"))
    first = stage_rows(first, "orders")
    rows = wanted.join(first.where("open").select("order_id"), "order_id").repartitionByRange("product_id", "order_id")
    rows = rows.select(F.spark_partition_id().alias("part"), "product_id", "order_id", "quantity", "stock", F.lit(False).alias("taken"))
    rows = stage_rows(rows, "open-demand")
    decided = [first.where(~F.col("open")).select("order_id", F.lit(False).alias("accepted"))]
    while not rows.where(~F.col("taken")).isEmpty():
        state = stage_rows(_decided(rows), "open-demand")
        known = state.where(F.col("accepted").isNotNull()).select("order_id", "accepted")
        decided.append(known.distinct())
        rows = state.where(F.col("taken") | F.coalesce("accepted", F.lit(True)))
        rows = rows.withColumn("taken", F.col("taken") | F.col("accepted").isNotNull()).drop("accepted")
        still = rows.where(~F.col("taken")).select("product_id").distinct()
        rows = rows.join(still, "product_id", "left_semi")
    return reduce(DataFrame.unionByName, decided)


def _decided(rows: DataFrame) -> DataFrame:
    """``rows`` with ``accepted`` for the orders that this round decides, null for taken and open ones."""
    amount = F.col("quantity")
    rows = rows.withColumns(
        {
            "most": F.when(F.col("taken"), amount).otherwise(F.greatest(amount, F.lit(0))),
            "least": F.when(F.col("taken"), amount).otherwise(F.least(amount, F.lit(0))),
        }
    )
    sums = rows.groupBy("product_id", "part").agg(F.sum("most").alias("most_before"), F.sum("least").alias("least_before"))
    earlier = Window.partitionBy("product_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({c: F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in ("most_before", "least_before")})
    within = Window.partitionBy("product_id", "part").orderBy("order_id").rowsBetween(Window.unboundedPreceding, -1)
    before = {f"{c}_here": F.coalesce(F.sum(c).over(within), F.lit(0)) for c in ("most", "least")}
    rows = rows.withColumns(before).join(sums, ["product_id", "part"])
    fits = amount <= F.col("stock") - F.col("most_before") - F.col("most_here")
    fails = amount > F.col("stock") - F.col("least_before") - F.col("least_here")
    verdicts = rows.where(~F.col("taken")).groupBy("order_id").agg(F.bool_and(fits).alias("fits"), F.bool_or(fails).alias("fails"))
    accepted = F.when(F.col("fits"), True).when(F.col("fails"), False)
    verdicts = verdicts.select("order_id", accepted.alias("accepted")).where(F.col("accepted").isNotNull())
    kept = rows.select("part", "product_id", "order_id", "quantity", "stock", "taken")
    return kept.join(verdicts, "order_id", "left")


def stock_left(items: DataFrame, stock: DataFrame, orders: DataFrame) -> DataFrame:
    """``stock`` with ``left``: what the accepted of ``orders`` leave of each product."""
    taken = items.join(orders.where("accepted").select("order_id"), "order_id", "left_semi")
    taken = taken.groupBy("product_id").agg(F.sum("quantity").alias("__taken"))
    joined = stock.join(taken, "product_id", "left")
    return joined.withColumn("left", F.col("stock") - F.coalesce("__taken", F.lit(0))).drop("__taken")


def loyalty_points(orders: DataFrame) -> DataFrame:
    """One point per ten units of each order's total, added up per customer."""
    points = F.floor(F.col("total") / AMOUNT_PER_POINT)
    return orders.groupBy("customer_id").agg(F.sum(points).alias("points"))


def status_valid(column: str | Column, statuses: Sequence[str] = STATUSES) -> Column:
    source = F.col(column) if isinstance(column, str) else column
    return F.coalesce(source.isin(list(statuses)), F.lit(False))


def coupon_applied(code: str, valid: str = COUPON) -> Column:
    """Whether the code is the valid coupon; no code is none."""
    return F.coalesce(F.col(code) == valid, F.lit(False))


def coupon_total(total: str, code: str, percent: str | Column, valid: str = COUPON) -> Column:
    percent = F.col(percent) if isinstance(percent, str) else percent
    amount = F.col(total)
    return F.when(coupon_applied(code, valid), amount - amount * (percent / 100)).otherwise(amount)


def orders_of(orders: DataFrame, customer_id: int) -> DataFrame:
    return orders.where(F.col("customer_id") == customer_id)


def order_by_id(orders: DataFrame, order_id: int) -> DataFrame:
    return orders.where(F.col("order_id") == order_id)


def add_products(products: DataFrame, new: DataFrame) -> DataFrame:
    """Products with the new ones added; an id that exists already is not replaced."""
    return products.unionByName(new.join(products.select("product_id"), "product_id", "left_anti"))


def remove_products(products: DataFrame, removed: DataFrame) -> DataFrame:
    return products.join(removed.select("product_id"), "product_id", "left_anti")
