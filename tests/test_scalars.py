from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.functions import scalars as S
from ledgerloom.functions.columns import all_nullable, dictionary_projection, ensure_columns
from ledgerloom.functions.predicates import all_equal, any_of, same_year
from ledgerloom.functions.scenarios import RUN_MODES, restage_scenario, scenario_ids, select_scenarios
from ledgerloom.functions.types import MONEY


def one(spark, sql, *columns):
    return tuple(spark.sql(f"SELECT {sql}").select(*columns).first())


def test_code_of_defaults_for_unknown_and_null(spark):
    rows = spark.createDataFrame([("RE",), ("XX",), (None,)], "s string")
    assert [r[0] for r in rows.select(S.code_of("s", {"RE": 3}, 1)).collect()] == [3, 1, 1]


def test_composite_label(spark):
    rows = spark.createDataFrame([("u", "n", "p"), ("u", "n", None), (None, "n", "p"), ("u", None, "p")], "u string, n string, p string")
    assert [r[0] for r in rows.select(S.composite_label("u", "n", "p")).collect()] == ["u_np", "u_n", None, None]


def test_signed_sum_counts_missing_as_zero(spark):
    sql = "CAST(NULL AS DECIMAL(24,10)) a, CAST(2 AS DECIMAL(24,10)) b, CAST(5 AS DECIMAL(24,10)) c"
    value, only_minus = one(spark, sql, S.signed_sum(["a", "b"], ["c"]), S.signed_sum([], ["c"]))
    assert value == Decimal(-3) and only_minus == Decimal(-5)


def test_ratio_by_zero_and_null_is_null(spark):
    sql = "CAST(1 AS DECIMAL(24,10)) a, CAST(0 AS DECIMAL(24,10)) z, CAST(NULL AS DECIMAL(24,10)) n, CAST(4 AS DECIMAL(24,10)) d"
    assert one(spark, sql, S.safe_ratio("a", "z"), S.safe_ratio("a", "n"), S.safe_ratio("n", "d"), S.safe_ratio("a", "d")) == (
        None, None, Decimal(0), Decimal("0.25"),
    )


def test_half_even_ties(spark):
    rows = spark.createDataFrame([(Decimal("0.125"),), (Decimal("0.135"),), (Decimal("-0.125"),)], "v decimal(24,10)")
    assert [r[0] for r in rows.select(F.bround("v", 2).cast("decimal(24,2)")).collect()] == [
        Decimal("0.12"), Decimal("0.14"), Decimal("-0.12"),
    ]


def test_text_helpers(spark):
    sql = "'a,b,c' u, 'Mov. Mex. EES' l, '2024-01-01T10:00' t, 'NULL' n, '' e"
    got = one(
        spark, sql, S.clean_unit("u"), S.strip_pattern("l", "Mov. Mex."), S.iso_to_blank("t"), S.null_text("n"),
        F.col("e").try_cast("int"),
    )
    assert got == ("a.b.c", " EES", "2024-01-01 10:00", None, None)


def test_unit_factor(spark):
    rows = spark.createDataFrame(
        [("m", "m", None), ("m", "l", None), ("m", "l", 3.0), ("m", "m", 2.0), (None, "m", None)], "a string, b string, f double"
    )
    assert [r[0] for r in rows.select(S.unit_factor("f", "a", "b", 1)).collect()] == [1.0, None, 3.0, 2.0, None]


def test_adjustment(spark):
    rows = spark.createDataFrame(
        [(3, Decimal(10), Decimal(7)), (2, Decimal(10), Decimal(7)), (3, Decimal(10), None)],
        "s int, c decimal(24,10), r decimal(24,10)",
    )
    rows = rows.withColumn("d", S.adjustment("s", 3, "c", "r"))
    assert [tuple(r) for r in rows.select("d", S.adjusted("c", "r", "d")).collect()] == [
        (Decimal(3), Decimal(7)), (Decimal(0), Decimal(10)), (None, Decimal(10)),
    ]


def test_ensure_columns_ignores_case(spark):
    df = spark.createDataFrame([(1, 2)], "Alpha int, b int")
    out = ensure_columns(df, ["ALPHA", "gamma", "GAMMA"])
    assert out.columns == ["Alpha", "b", "gamma"]
    assert out.schema["gamma"].dataType == MONEY
    assert ensure_columns(df, ["z"], 0).first()["z"] == Decimal(0)


def test_dictionary_projection_of_missing_label(spark):
    df = spark.createDataFrame([(1, Decimal(2))], "k int, `a b##c` decimal(10,2)")
    row = dictionary_projection(df, ["k"], {"a b##c": "x", "absent": "y"}).first()
    assert (row["x"], row["y"]) == (Decimal(2), None)


def test_all_nullable(spark):
    df = all_nullable(spark.range(2))
    assert df.schema["id"].nullable and df.count() == 2


def test_predicates(spark):
    df = spark.createDataFrame([(20230101, "a"), (20231231, "b"), (20240101, "a"), (20230501, None)], "d int, s string")
    assert df.where(same_year("d", 20230601)).count() == 3
    assert df.where(all_equal({"s": ["a", "b"], "d": 20240101})).count() == 1
    assert df.where(any_of([{"s": "b"}, {"d": 20240101}])).count() == 2


def test_scenario_modes(spark):
    df = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "scenario_id int")
    fact = {m: sorted(r[0] for r in select_scenarios(df, m, "fact").collect()) for m in RUN_MODES}
    assert fact == {"ALL": [1, 2, 3, 4], "PA-UPA": [2, 4], "EST": [1], "REAL": [3], "PA": [2], "UPA": [4]}
    assert scenario_ids("PA-UPA", "published") == [2, 3]
    assert [r[0] for r in df.select(restage_scenario("scenario_id", "fact", "published")).collect()] == [4, 2, 1, 3]


def test_sums_of_many_operands_are_exact(spark):
    from decimal import Decimal

    from pyspark.sql import functions as F

    from ledgerloom.functions.scalars import signed_sum
    from ledgerloom.plans.formulas import apply_formulas, total

    names = [f"c{k}" for k in range(25)]
    row = spark.range(1).select(F.lit(1).alias("scenario_id"), *[F.lit(Decimal("0.0000000001")).cast("decimal(24,10)").alias(n) for n in names])
    assert row.select(signed_sum(names)).first()[0] == Decimal("0.0000000025")
    assert row.select(signed_sum(names[:3], names[3:])).first()[0] == Decimal("-0.0000000019")
    assert apply_formulas(row, [total("all", *names)]).first()["all"] == Decimal("0.0000000025")
