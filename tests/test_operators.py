from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.aggregates import has_data, only_if, reconcile_counts
from ledgerloom.operators.dedup import dedup_subset
from ledgerloom.operators.joins import anti_join_trimmed, attach_scalar, full_outer_left_keys, join_keys_null_safe, map_join
from ledgerloom.operators.numbering import number_rows
from ledgerloom.operators.reshape import pivot_back, pivot_sum, transpose, unpivot_tagged
from ledgerloom.operators.setops import union_by_name
from ledgerloom.plans.keys import extend_dimension, surrogate_key_delta
from ledgerloom.sources.tables import literal_table, neutral_table


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def many_partitions(spark):
    """Keep Spark from merging the small partitions of test data."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


def test_number_rows_matches_row_number_with_a_hot_value(spark, many_partitions):
    """A third of the rows share one value of the first order column."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 7919 % 1000).alias("k"), "id"
    )
    numbered = number_rows(df, ["k", "id"], "n")
    expected = {i: n for n, (_, i) in enumerate(sorted((r.k, r.id) for r in df.collect()), start=1)}
    assert {r.id: r.n for r in numbered.collect()} == expected


def test_number_rows_per_group_with_null_group(spark, many_partitions):
    df = spark.createDataFrame([("a", 3), ("a", 1), (None, 5), ("b", 2), (None, 4)], "g string, v int")
    assert {(r.g, r.v): r.n for r in number_rows(df, ["v"], "n", ["g"]).collect()} == {
        ("a", 1): 1, ("a", 3): 2, (None, 4): 1, (None, 5): 2, ("b", 2): 1,
    }


def test_numbering_uses_several_partitions(spark, many_partitions):
    """The order is split over tasks; only the partition sizes meet in one."""
    df = spark.range(50_000).select((F.col("id") * 7919 % 50_021).alias("v"))
    numbered = number_rows(df, ["v"], "n")
    assert numbered.select(F.spark_partition_id()).distinct().count() > 1
    assert numbered.agg(F.count_distinct("n"), F.max("n")).first() == (50_000, 50_000)


def test_surrogate_keys(spark, many_partitions):
    source = spark.createDataFrame([(" b ",), ("a",), ("c",)], "k string")
    empty = literal_table(spark, "id int, k string", [])
    assert rows(surrogate_key_delta(source, empty, "id", "k")) == [(" b ", 1), ("a", 2), ("c", 3)]
    target = literal_table(spark, "id int, k string", [(7, "b"), (3, "z ")])
    assert rows(surrogate_key_delta(source, target, "id", "k")) == [("a", 8), ("c", 9)]
    extended = extend_dimension(source.union(source).union(spark.createDataFrame([(None,)], "k string")), target, "id", "k")
    assert rows(extended) == [(3, "z "), (7, "b"), (8, "a"), (9, "c")]
    again = extend_dimension(source, extended, "id", "k")
    assert rows(again) == rows(extended)


def test_anti_join_keeps_null_keys(spark):
    left = spark.createDataFrame([("a ",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([(" a",), (None,)], "k string")
    assert sorted(r[0] or "" for r in anti_join_trimmed(left, right, "k").collect()) == ["", "b"]


def test_full_outer_drops_right_keys(spark):
    left = spark.createDataFrame([(1, 1, "l1"), (2, 1, "l2")], "p int, s int, a string")
    right = spark.createDataFrame([(1, 1, "r1"), (3, 1, "r3")], "q int, t int, b string")
    got = {tuple(r) for r in full_outer_left_keys(left, right, {"p": "q", "s": "t"}).collect()}
    assert got == {(1, 1, "l1", "r1"), (2, 1, "l2", None), (None, None, None, "r3")}


def test_full_outer_of_repeated_and_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "p int, a string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (3, "w")], "q int, b string")
    got = sorted((tuple(r) for r in full_outer_left_keys(left, right, {"p": "q"}).collect()), key=str)
    want = [(1, a, b) for a in "ab" for b in "xy"] + [(None, "c", None), (2, "d", None), (None, None, "z"), (None, None, "w")]
    assert got == sorted(want, key=str)
    again = full_outer_left_keys(left, left.withColumnsRenamed({"p": "q", "a": "b"}), {"p": "q"})  # one table on both sides
    assert again.count() == 4 + 1 + 1 + 1


def test_full_outer_splits_a_hot_key(spark, many_partitions):
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    }
    for key, value in low.items():
        spark.conf.set(key, value)
    try:
        ids = spark.range(0, 60_000, 1, 8)
        left = ids.select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("p"), F.col("id").alias("a"))
        right = spark.range(5_000).select(F.col("id").alias("q"), (F.col("id") * 2).alias("b"))
        joined = full_outer_left_keys(left, right, {"p": "q"})
        assert len(joined.collect()) == 60_000 + right.join(left, left.p == right.q, "left_anti").count()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "FullOuter" not in plan and "skew=true" in plan
    finally:
        for key in low:
            spark.conf.unset(key)


def test_scalar_without_a_row_empties_the_result(spark):
    df = spark.range(3)
    rate = spark.createDataFrame([(2.5,)], "rate double")
    assert rows(attach_scalar(df, rate, "rate")) == [(0, 2.5), (1, 2.5), (2, 2.5)]
    assert attach_scalar(df, rate.limit(0), "rate").count() == 0
    assert attach_scalar(df, rate.select(F.lit(None).cast("double").alias("rate")), "rate").count() == 3
    with pytest.raises(Exception, match="(?i)more than one row|TOO_MANY_ROWS"):
        attach_scalar(df, rate.union(rate), "rate").count()


def test_null_safe_keys(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w int")
    assert {tuple(r) for r in join_keys_null_safe(left, right, ["k"]).collect()} == {(None, 1, 10), ("a", 2, 20)}


def test_map_join_fans_out(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y")], "a int, u string")
    right = spark.createDataFrame([("x", 5), ("x", 6)], "u string, v int")
    joined = map_join(left, right, {"u": "u"}, ["v"])
    assert {tuple(r) for r in joined.collect()} == {(1, "x", 5), (1, "x", 6), (2, "y", None)}


def test_pivot_null_label_and_absent_label(spark):
    df = spark.createDataFrame(
        [(1, "a", Decimal(1)), (1, None, Decimal(2)), (1, "a", Decimal(3)), (2, "b", Decimal(9))], "k int, l string, v decimal(24,10)"
    )
    assert rows(pivot_sum(df, ["k"], "l", "v", ["a", "null", "never"])) == [
        (1, Decimal(4), Decimal(2), None), (2, None, None, None),
    ]


def test_unpivot_drops_null_amounts_and_repeats_metrics(spark):
    wide = spark.createDataFrame([(1, Decimal(5), None)], "k int, a decimal(10,2), b decimal(10,2)")
    mapping = spark.createDataFrame([("a", 10), ("a", 20), ("b", 30)], "metric string, report int")
    assert {(r.metric, r.report, r.amount) for r in unpivot_tagged(wide, ["k"], ["a", "b"], mapping).collect()} == {
        ("a", 10, Decimal(5)), ("a", 20, Decimal(5)),
    }


def test_transpose_round_trip(spark):
    df = spark.createDataFrame([(1, 1.5, None), (2, None, 4.0), (3, None, None)], "k int, a double, b double")
    back = pivot_back(transpose(df, ["k"], ["a", "b"]), ["k"], ["a", "b"])
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in df.collect()}


def test_dedup_subset_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (1, None, 1), (None, "z", 1), (None, "y", 5)], "k int, s string, v int")
    expected = {(1, None, 1), (None, "y", 5)}
    assert {tuple(r) for r in dedup_subset(df, ["k"]).collect()} == expected
    assert {tuple(r) for r in dedup_subset(df.orderBy(F.desc("v")), ["k"]).collect()} == expected


def test_dedup_combines_before_the_shuffle(spark):
    plan = dedup_subset(spark.range(10).select((F.col("id") % 2).alias("k"), "id"), ["k"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    before = text.index("Exchange")  # plans are printed from the result down: the limit stands below the exchange, too
    assert "WindowGroupLimit" in text[before:]


def test_guard_and_reconciliation(spark):
    data = spark.createDataFrame([(None,), (None,)], "v int")
    assert only_if(spark.range(3), has_data(data, "v")).count() == 0
    assert only_if(spark.range(3), has_data(data.limit(0), "v")).count() == 0
    assert only_if(spark.range(3), has_data(data.union(spark.createDataFrame([(0,)], "v int")), "v")).count() == 3
    assert reconcile_counts(spark.range(3), spark.range(2)).first() == (3, 2, False)


def test_neutral_table_is_the_identity_of_union(spark):
    assert rows(union_by_name(neutral_table(spark), spark.range(2))) == [(0,), (1,)]
