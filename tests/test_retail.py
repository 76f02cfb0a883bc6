import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import retail as R


def stock(spark):
    return spark.createDataFrame(
        [(1, "a", 2.0, 5), (2, "b", 3.0, 20), (3, "c", 1.0, None)], "product_id int, name string, price double, stock int"
    )


def test_discount_outside_the_range_is_null(spark):
    rows = spark.createDataFrame([(100.0, p) for p in (0.0, 25.0, 100.0, -1.0, 101.0)] + [(100.0, None)], "price double, p double")
    assert [r[0] for r in rows.select(R.discounted_price("price", "p")).collect()] == [100.0, 75.0, 0.0, None, None, None]


def test_stock_after_movements(spark):
    moves = spark.createDataFrame([(1, -3), (1, -4), (2, 1)], "product_id int, quantity int")
    got = {r.product_id: (r.stock_after, r.covered) for r in R.stock_after(stock(spark), moves).collect()}
    assert got == {1: (-2, False), 2: (21, True), 3: (None, None)}


def test_validation(spark):
    items = spark.createDataFrame([(1, 1, 5), (1, 2, 21), (2, 9, 1), (3, 3, 1), (4, 2, 20)], "order_id int, product_id int, quantity int")
    got = {(r.order_id, r.product_id): r.verdict for r in R.validate_items(items, stock(spark)).collect()}
    assert got == {(1, 1): "ok", (1, 2): R.SHORT, (2, 9): R.UNKNOWN, (3, 3): R.SHORT, (4, 2): "ok"}
    accepted = {r.order_id: r.accepted for r in R.accepted_orders(items, stock(spark)).collect()}
    assert accepted == {1: False, 2: False, 3: False, 4: True}


def test_points_are_counted_per_order(spark):
    orders = spark.createDataFrame([(1, 19.99), (1, 10.0), (2, 9.0)], "customer_id int, total double")
    assert {r.customer_id: r.points for r in R.loyalty_points(orders).collect()} == {1: 2, 2: 0}


def test_status_and_coupon(spark):
    rows = spark.createDataFrame([("pending", "WELCOME10"), ("lost", "other"), (None, None)], "s string, code string")
    rows = rows.withColumn("total", F.lit(200.0))
    got = rows.select(R.status_valid("s"), R.coupon_total("total", "code", F.lit(10.0)), R.coupon_applied("code")).collect()
    assert [tuple(r) for r in got] == [(True, 180.0, True), (False, 200.0, False), (False, 200.0, False)]


def test_report_and_upsert(spark):
    report = {r["product"]: r.value for r in R.inventory_report(stock(spark)).collect()}
    assert report == {"a": 10.0, "b": 60.0, "c": None, "TOTAL": 70.0}
    assert [r.product_id for r in R.low_stock(stock(spark)).collect()] == [1]
    known = stock(spark).select("product_id", "name")
    new = spark.createDataFrame([(2, "x"), (4, "d")], "product_id int, name string")
    assert sorted(tuple(r) for r in R.add_products(known, new).collect()) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    assert sorted(r.product_id for r in R.remove_products(known, new).collect()) == [1, 3]


def test_lines_of_one_order_share_the_stock(spark):
    items = spark.createDataFrame([(1, 2, 12), (1, 2, 12), (2, 2, 12), (2, 1, 5), (3, 2, None)], "order_id int, product_id int, quantity int")
    got = {r.order_id: r.accepted for r in R.accepted_orders(items, stock(spark)).collect()}
    assert got == {1: False, 2: True, 3: False}


def sequential(items, stock):
    left, wanted = dict(stock), {}
    for order, product, quantity in items:
        own = wanted.setdefault(order, {})
        own[product] = None if quantity is None or own.get(product, 0) is None else own.get(product, 0) + quantity
    out = {}
    for order in sorted(wanted):
        own = wanted[order]
        out[order] = all(left.get(p) is not None and q is not None and q <= left[p] for p, q in own.items())
        if out[order]:
            for p, q in own.items():
                left[p] -= q
    return out, left


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_orders_use_up_the_stock(spark, seed):
    rng = random.Random(seed)
    products = {p: rng.randrange(5, 60) for p in range(6)} | {6: None, 7: 4000}
    items = []
    for order in range(300):
        for _ in range(rng.randrange(1, 4)):
            product = 7 if rng.random() < 0.4 else rng.randrange(9)
            quantity = None if rng.random() < 0.02 else -rng.randrange(9) if seed == 3 and rng.random() < 0.2 else rng.randrange(1, 25)
            items.append((order, product, quantity))
    rng.shuffle(items)
    want, left = sequential(items, products)
    rows = spark.createDataFrame(items, "order_id int, product_id int, quantity int")
    stock = spark.createDataFrame(list(products.items()), "product_id int, stock int")
    orders = R.fulfilled_orders(rows, stock)
    got = [(r.order_id, r.accepted) for r in orders.collect()]
    assert len(got) == len(want) and dict(got) == want
    assert 0 < sum(want.values()) < len(want)
    assert {r.product_id: r.left for r in R.stock_left(rows, stock, orders).collect()} == left


def test_a_rejected_order_leaves_its_stock_free(spark):
    items = spark.createDataFrame(
        [(1, 1, 4), (2, 1, 3), (2, 2, 99), (3, 1, 1), (4, 1, 1), (None, 1, 5), (5, 3, 1)], "order_id int, product_id int, quantity int"
    )
    stock = spark.createDataFrame([(1, 5), (2, 9)], "product_id int, stock int")
    got = {r.order_id: r.accepted for r in R.fulfilled_orders(items, stock).collect()}
    assert got == {1: True, 2: False, 3: True, 4: False, 5: False}
    assert R.fulfilled_orders(items.limit(0), stock).count() == 0


def test_no_window_over_raw_lines(spark):
    items = spark.createDataFrame([(1, 1, 4)], "order_id int, product_id int, quantity int")
    stock = spark.createDataFrame([(1, 5)], "product_id int, stock int")
    for df in (R.validate_items(items, stock), R.accepted_orders(items, stock)):
        assert "Window" not in df._jdf.queryExecution().optimizedPlan().toString()
