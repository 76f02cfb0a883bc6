import os
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerloom.plans.currency import currency_block, pass_through, rewrite_rate_concept
from ledgerloom.plans.facts import MASTER_COLUMNS, build_fact, keyed_amounts, union_masters
from ledgerloom.plans.formulas import apply_formulas, needed, ratio, total
from ledgerloom.plans import keys
from ledgerloom.plans.month import Month, run_month
from ledgerloom.plans.periods import (
    BY_COST_TYPE,
    attach_cumulative,
    difference_from_previous,
    estimate_series,
    month_from_fx_cumulative,
    period_and_ytd,
    period_by_difference,
)
from ledgerloom.plans.publish import PUBLISHED_COLUMNS, publish, published_rows
from ledgerloom.plans.reports import MAPPING_SCHEMA, attach_dimensions
from ledgerloom.plans.units import conversion_factors, convert_units
from ledgerloom.plans.wide import build_wide, build_wide_of_keys
from ledgerloom.queries import QUERIES
from ledgerloom.session import new_path, stage_rows, stage_scope
from ledgerloom.sources import folders
from ledgerloom.sources.sinks import overwrite_partitions
from ledgerloom.sources.tables import literal_table

ROW = (
    "report_id int, concept_id int, business_id string, company_id int, data_type_id int, dim1_id int, dim2_id int, "
    "scenario_id int, amount decimal(24,3), rate_acc decimal(24,10), rate_month decimal(24,10), currency string, period_date int"
)


def line(scenario, date, amount, data_type=2, currency="Pesos", concept=30, rate="10", dim1=1):
    return (
        13, concept, "B1", None, data_type, dim1, None, scenario, None if amount is None else Decimal(amount),
        None if rate is None else Decimal(rate), None if rate is None else Decimal(rate), currency, date,
    )


def table_of(spark, *lines):
    return literal_table(spark, ROW, lines)


def amounts(df, *columns):
    return sorted(((*[r[c] for c in columns], None if r.amount is None else float(r.amount)) for r in df.collect()), key=str)


# ------------------------------------------------------------------------------------- periods


def test_ytd_shares_the_total_among_equal_dates(spark):
    df = spark.createDataFrame([("a", 20230101, 1), ("a", 20230101, 2), ("a", 20230301, 4), ("a", 20240101, 8), (None, 20230101, 16)], "k string, d int, v int")
    got = attach_cumulative(df, ["k"], "d", "v").select("k", "d", "v", "ytd").collect()
    assert {tuple(r) for r in got} == {
        ("a", 20230101, 1, 3), ("a", 20230101, 2, 3), ("a", 20230301, 4, 7), ("a", 20240101, 8, 8), (None, 20230101, 16, 16),
    }


def test_ytd_with_a_hot_series(spark):
    """A third of the rows form one series; it reaches the window as one row per date."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
        (20230001 + (F.col("id") % 12 + 1) * 100).cast("int").alias("d"),
        F.lit(1).alias("v"),
    )
    hot = attach_cumulative(df, ["k"], "d", "v").where("k = -1").groupBy("d").agg(F.max("ytd"), F.min("ytd"), F.count("*")).orderBy("d").collect()
    running = 0
    for date, high, low, count in [tuple(r) for r in hot]:
        running += count
        assert (high, low) == (running, running), date


def test_last_month_ytd_is_the_sum_of_the_months(spark):
    rows = table_of(spark, *[line(1, 20230001 + 100 * m, m) for m in range(1, 13)])
    both = period_and_ytd(rows)
    assert amounts(both.where("period_date = 20231201 and data_type_id = 1")) == [(78.0,)]
    current = period_and_ytd(rows, period=20231201)
    assert amounts(current, "data_type_id") == amounts(both.where("period_date = 20231201"), "data_type_id")


def test_null_amounts_and_repeated_rows(spark):
    rows = table_of(spark, line(1, 20230201, "5"), line(1, 20230201, "5"), line(1, 20230201, None), line(1, 20230101, "1"))
    assert amounts(period_and_ytd(rows, period=20230201), "data_type_id") == [
        (1, 11.0), (1, 11.0), (2, 5.0), (2, 5.0),
    ]


def test_lag_takes_the_previous_existing_date_or_zero(spark):
    df = spark.createDataFrame([("a", 1, Decimal(5)), ("a", 4, Decimal(9)), ("b", 2, Decimal(3))], "k string, d int, v decimal(24,3)")
    got = difference_from_previous(df, ["k"], "d", "v")
    assert {(r.k, r.d, int(r.difference)) for r in got.collect()} == {("a", 1, 5), ("a", 4, 4), ("b", 2, 3)}


def test_fx_months_need_their_predecessor(spark):
    money = "scenario_id int, period int, v decimal(24,10)"
    df = spark.createDataFrame([(1, 202301, Decimal(10)), (1, 202302, Decimal(5)), (1, 202304, Decimal(7)), (1, 202305, Decimal(1)), (2, 202302, Decimal(1))], money)
    rates = spark.createDataFrame([(1, p, Decimal(r)) for p, r in [(202301, 2), (202302, 3), (202304, 1), (202305, 2)]], "scenario_id int, period int, rate decimal(24,10)")
    got = month_from_fx_cumulative(df, rates, ["scenario_id"], "period", "v", "rate")
    assert {(r.scenario_id, r.period, int(r.v)) for r in got.collect()} == {
        (1, 202301, 20), (1, 202302, 25), (1, 202305, 24),
    }


def test_estimate_continues_real_months(spark):
    history = table_of(
        spark, line(1, 20230101, 1), line(1, 20230201, 2), line(4, 20230201, 20), line(4, 20230301, 30), line(1, 20221201, 99),
        line(1, 20230101, 77, currency="Euros"), line(1, 20230101, 78, data_type=1), line(2, 20230301, 55),
    )
    now = table_of(spark, line(4, 20230401, 40), line(1, 20230401, 4), line(2, 20230401, 6))
    assert amounts(estimate_series(history, now, 20230401), "scenario_id", "period_date") == [
        (4, 20230101, 1.0), (4, 20230201, 2.0), (4, 20230301, 30.0), (4, 20230401, 4.0),
    ]
    no_real = now.where("scenario_id <> 1")
    assert amounts(estimate_series(history, no_real, 20230401), "period_date")[-1] == (20230401, 40.0)
    assert amounts(estimate_series(history, now, 20230401, include_current=False), "period_date")[-1] == (20230301, 30.0)


def test_empty_estimate(spark):
    history = table_of(spark, line(1, 20230101, 1))
    now = table_of(spark, line(4, 20230401, None), line(1, 20230401, 4))
    assert amounts(estimate_series(history, now, 20230401), "scenario_id") == [(4, None)]
    assert estimate_series(history, now.where("scenario_id = 1"), 20230401).count() == 0
    assert estimate_series(history, now, 20230401, include_current=False).count() == 0


def test_differences_of_a_year_add_up(spark):
    ytd = [line(1, 20230001 + 100 * m, 10 * m * m, data_type=1, currency="Euros") for m in (1, 2, 5)]
    total_of_months = 0
    for position, row in enumerate(ytd):
        history, current = table_of(spark, *ytd[:position]), table_of(spark, row)
        got = period_by_difference(history, current, row[-1]).collect()
        assert len(got) == 1 and got[0].data_type_id == 2
        total_of_months += got[0].amount
    assert total_of_months == Decimal(250)


def test_difference_of_the_estimate_uses_real_history(spark):
    history = table_of(spark, line(1, 20230101, 7, 1, "Euros"), line(4, 20230101, 99, 1, "Euros"), line(1, 20221201, 5, 1, "Euros"))
    current = table_of(spark, line(4, 20230201, 10, 1, "Euros"), line(2, 20230201, 3, 1, "Euros"), line(1, 20230201, 9, 2, "Pesos"))
    assert amounts(period_by_difference(history, current, 20230201), "scenario_id") == [(2, 3.0), (4, 3.0)]


def test_metrics_of_one_series_carry_its_total_once(spark):
    """Both rows hold the year-to-date total of the whole series."""
    history = table_of(spark, line(1, 20230101, 1000, 1, "Euros"))
    current = table_of(spark, line(1, 20230201, 2200, 1, "Euros"), line(1, 20230201, 2200, 1, "Euros"))
    assert amounts(period_by_difference(history, current, 20230201), "scenario_id") == [(1, 1200.0)]


# ------------------------------------------------------------------------------------ currency


def test_currency_block(spark):
    rows = table_of(
        spark, line(1, 20230101, 5000, 1), line(1, 20230101, 5000, 1), line(1, 20230101, 7, 2), line(2, 20230101, 100, 1, rate="0"),
        line(3, 20230101, 100, 1, rate=None), line(4, 20230101, 100, 1, concept=None), line(4, 20230101, None, 1),
    )
    assert amounts(currency_block(rows), "currency", "scenario_id", "data_type_id") == [
        ("Euros", 1, 1, 0.5), ("Pesos", 1, 1, 5000.0), ("Pesos", 1, 2, 7.0), ("Pesos", 2, 1, 100.0), ("Pesos", 3, 1, 100.0), ("Pesos", 4, 1, 100.0),
    ]


def test_rate_concept(spark):
    rows = table_of(spark, line(1, 1, 10, 1, concept=1), line(1, 1, 2, 2, concept=1), line(1, 1, 30, 1), line(1, 1, 3, 2), line(1, 1, 9, 1, concept=None), line(1, 1, 8, 2, concept=None))
    assert amounts(rewrite_rate_concept(rows), "concept_id", "data_type_id") == [
        (1, 1, 2.0), (1, 2, 2.0), (30, 1, 30.0), (30, 2, 3.0), (None, 2, 8.0),
    ]


def test_pass_through(spark):
    rows = table_of(spark, line(1, 1, 5, concept=2), line(1, 1, 6, currency="Euros", concept=2), line(1, 1, 7), line(1, 1, 8, currency="Euros"), line(1, 1, 9, currency="Euros", concept=None))
    assert amounts(pass_through(rows), "concept_id", "currency") == [
        (2, "Euros", 5.0), (2, "Pesos", 5.0), (30, "Euros", 8.0), (30, "Pesos", 7.0),
    ]


# ------------------------------------------------------------------------------------ formulas


def wide(spark):
    return spark.createDataFrame([(3, Decimal(6), Decimal(2), None)], "scenario_id int, a decimal(24,10), b decimal(24,10), c decimal(24,10)")


def test_formulas_use_the_latest_definition(spark):
    formulas = [
        total("s", "a", "b"), ratio("r", "s", "c"), total("r", "r", redefine=True), total("t", "s", minus=["a"]),
        total("s", "s", "t", redefine=True), total("u", "s"),
    ]
    row = apply_formulas(wide(spark), formulas).first()
    assert (row.s, row.r, row.t, row.u) == (Decimal(10), Decimal(0), Decimal(2), Decimal(10))


def test_formulas_reject_duplicates_and_unknown_operands(spark):
    with pytest.raises(ValueError, match="twice"):
        apply_formulas(wide(spark), [total("a", "b")])
    with pytest.raises(ValueError, match="not defined"):
        apply_formulas(wide(spark), [total("x", "y"), total("y", "x")])


def test_formulas_take_one_projection_per_level(spark):
    many = [total(f"f{i}", "a", "b") for i in range(50)] + [total(f"g{i}", f"f{i}") for i in range(50)]
    plan = apply_formulas(wide(spark), many)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") <= 5


# --------------------------------------------------------------------------------------- facts


def master(spark, *rows):
    schema = ", ".join(f"{c} {'decimal(24,10)' if c == 'value' else 'string'}" for c in MASTER_COLUMNS)
    return literal_table(spark, schema, rows)


def kpi(scenario, unit="u,1", product="p", value="1.005", period_type="m", origin="o"):
    return (scenario, "202301", unit, "c", "MX", product, origin, "ch", "Costes Fijos", "n", "k", Decimal(value), "eur", period_type)


def test_fact_of_unknown_labels_and_duplicates(spark):
    masters = union_masters("ALL", master(spark, kpi("RE"), kpi("RE", origin="a")), master(spark, kpi("PA", product=None)), master(spark, kpi("EST", unit=None)))
    dimension = literal_table(spark, "kpi_id int, kpi_label string", [(5, "u.1_np")])
    got = {(r.scenario_id, r.kpi_id, r.business_unit, r.origin, str(r.value), r.period_type) for r in build_fact(masters, dimension).collect()}
    assert got == {(3, 5, "u.1", "a", "1.0100000000", "m"), (2, None, "u.1", "o", "1.0100000000", "m"), (1, None, None, "o", "1.0100000000", "undefined")}


def test_wide_row_of_business_keys_agrees_with_the_fact(spark):
    """sums over the distinct keys by label are those over the keyed fact by id."""
    real = [kpi("RE"), kpi("RE", origin="a"), kpi("RE", value="2.00"), kpi("RE", value="1.006"), kpi("RE", product="p "), kpi("RE", unit=None)]
    budget = [kpi("PA", product=None), kpi("PA", product=None, value="-3"), kpi("UPA", product="q"), kpi("UPA", unit="u.1", product="q")]
    masters = union_masters("ALL", master(spark, *real), master(spark, *budget), master(spark, kpi("EST", period_type="z")))
    dimension = literal_table(spark, "kpi_id int, kpi_label string", [(5, "u.1_np"), (6, "u.1_n"), (7, "u.1_nq")])
    metrics = {"u.1_n": "bare", "u.1_np": "with_p", "u.1_nq": "with_q"}
    got = build_wide_of_keys(keyed_amounts(masters), dimension, metrics)
    expected = build_wide(build_fact(masters, dimension), dimension, metrics)
    assert got.schema.simpleString() == expected.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert {r.scenario_id: (r.bare, r.with_p, r.with_q) for r in got.collect()} == {
        3: (None, Decimal("3.01"), None), 2: (Decimal("-1.99"), None, None), 4: (None, None, Decimal("1.01")), 1: (None, Decimal("1.01"), None),
    }


def test_wide_metrics_sort_no_order_lines(spark, sf_dir):
    """duplicates go by hash; no numbering, and no columns that the wide row does not hold."""
    plan = QUERIES["wide_metrics_build"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" not in plan
    assert "kpi_code" not in plan


def test_masters_of_a_run_mode(spark):
    inputs = (master(spark, kpi("RE")), master(spark, kpi("PA"), kpi("UPA")), master(spark, kpi("EST")))
    found = {m: sorted(r.scenario for r in union_masters(m, *inputs).collect()) for m in ("REAL", "PA-UPA", "EST", "ALL")}
    assert found == {"REAL": ["RE"], "PA-UPA": ["PA", "UPA"], "EST": ["EST"], "ALL": ["EST", "PA", "RE", "UPA"]}


# --------------------------------------------------------------------------------------- units


def test_conversion_agrees_with_rows_and_pivot(spark):
    """The same conversion done attribute by attribute on a fixture with unique keys."""
    presentation = literal_table(spark, "class_name string, attribute_name string, uom string, id_bu string", [("S", "q", "V", "ARG"), ("S", "q", "V", "BRA"), ("X", "q", "Z", "ARG")])
    setup = literal_table(spark, "measurement_type string, unit string, db_unit string, view_unit string, id_bu string", [("V", "m3", "Y", "N", "ARG"), ("V", "l", "N", "Y", "ARG"), ("V", "l", "Y", "Y", "BRA"), ("V", "t", "N", "N", "BRA")])
    conversion = literal_table(spark, "from_unit string, to_unit string, mult_fact double, add_numb double", [("m3", "l", 1000.0, 1.0)])
    factors = conversion_factors(presentation, setup, conversion, "S")
    fact = spark.createDataFrame([(1, "ARG", 2.0), (2, "BRA", 3.0), (3, "PER", 4.0), (4, "ARG", None)], "k int, id_bu string, q double")
    got = {r.k: (r.q_m3, r.q_l) for r in convert_units(fact, factors, ["k"], [("q", "m3"), ("q", "l")]).collect()}
    long = fact.join(factors, "id_bu", "left").withColumn("v", F.col("q") * F.col("factor") + F.col("offset"))
    expected = {}
    for r in long.collect():
        values = expected.setdefault(r.k, {})
        values[r.to_unit] = r.v
    assert got == {k: (v.get("m3"), v.get("l")) for k, v in expected.items()}
    assert got == {1: (2.0, 2001.0), 2: (None, 3.0), 3: (None, None), 4: (None, None)}


@pytest.mark.parametrize(
    "setup_rows, conversion_rows, wanted, message",
    [
        ([("V", "m3", "Y", "N", "PER"), ("V", "bbl", "Y", "N", "CHL")], [("m3", "l", 1.8, 32.0), ("bbl", "l", 2.25, 1.0)], ["m3", "bbl", "l"], "several factors"),
        ([("V", "m3", "Y", "N", "PER")], [("m3", "l", 1.8, 32.0)], ["l"], "configured but not wanted"),
    ],
)
def test_conversion_refuses_to_choose(spark, setup_rows, conversion_rows, wanted, message):
    """Two "other" business units with different database units, and a pair nobody asked for."""
    presentation = literal_table(spark, "class_name string, attribute_name string, uom string, id_bu string", [("S", "q", "V", "PER")])
    setup = literal_table(spark, "measurement_type string, unit string, db_unit string, view_unit string, id_bu string", [*setup_rows, ("V", "l", "N", "Y", "PER")])
    conversion = literal_table(spark, "from_unit string, to_unit string, mult_fact double, add_numb double", conversion_rows)
    factors = conversion_factors(presentation, setup, conversion, "S")
    fact = spark.createDataFrame([(1, "PER", 10.0)], "k int, id_bu string, q double")
    with pytest.raises(Exception, match=message):
        convert_units(fact, factors, ["k"], [("q", u) for u in wanted]).collect()


def test_conversion_does_not_shuffle_the_fact_by_unit(spark):
    """hashed by business unit, a third of all rows or more met in one task."""
    presentation = literal_table(spark, "class_name string, attribute_name string, uom string, id_bu string", [("S", "q", "V", "ARG")])
    setup = literal_table(spark, "measurement_type string, unit string, db_unit string, view_unit string, id_bu string", [("V", "m3", "Y", "N", "ARG")])
    conversion = literal_table(spark, "from_unit string, to_unit string, mult_fact double, add_numb double", [("m3", "l", 1000.0, 1.0)])
    fact = spark.range(40).select(F.col("id").alias("k"), F.when(F.col("id") % 4 == 0, "PER").otherwise("ARG").alias("id_bu"), F.col("id").cast("double").alias("q"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        converted = convert_units(fact, conversion_factors(presentation, setup, conversion, "S"), ["k"], [("q", "m3")])
        plan = converted._jdf.queryExecution().executedPlan().toString()
        got = {r.k: r.q_m3 for r in converted.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("hashpartitioning(id_bu") == 1  # that of the factors
    assert got == {k: None if k % 4 == 0 else float(k) for k in range(40)}


def test_unit_conversion_keeps_order_lines_in_place(spark, sf_dir):
    """the registered query, where the check of sizes is as strict as on a small cluster."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    try:
        plan = QUERIES["unit_conversion"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning(id_bu") == 1  # that of the factors


# --------------------------------------------------------------------------------- publication


def test_publish_replaces_only_its_scenarios(spark):
    path = new_path(spark, "test-publish")
    old = table_of(
        spark, line(2, 20230101, 7), line(2, 20230201, 8), line(3, 20230201, 9), line(1, 20230201, 6), line(2, 20230101, "0.7", 1, "Euros"),
    )
    overwrite_partitions(old.select(*PUBLISHED_COLUMNS), path, ["period_date", "scenario_id"])
    now = table_of(spark, line(2, 20230201, 100), line(1, 20230201, 55))
    first = amounts(publish(now, path, 20230201, "PA-UPA"), "scenario_id", "currency", "data_type_id")
    assert first == [
        (2, "Euros", 1, 0.011), (2, "Euros", 2, -0.689), (2, "Pesos", 1, 107.0), (2, "Pesos", 2, 100.0),
    ]
    stored = spark.read.parquet(path)
    assert amounts(stored.where("scenario_id in (1, 3) or period_date = 20230101"), "scenario_id", "period_date", "currency") == [
        (1, 20230201, "Pesos", 6.0), (2, 20230101, "Euros", 0.7), (2, 20230101, "Pesos", 7.0),
    ]
    again = publish(now, path, 20230201, "PA-UPA")
    assert amounts(again, "scenario_id", "currency", "data_type_id") == first


def test_published_months_add_up_to_year_to_date(spark):
    months = [Decimal("12345.678"), Decimal("-77.01"), Decimal("900.5")]
    history = table_of(spark).select(*PUBLISHED_COLUMNS)
    for number, amount in enumerate(months, start=1):
        date = 20230001 + 100 * number
        rows = published_rows(table_of(spark, line(1, date, amount), line(4, date, 1)), history, date)
        stored = literal_table(spark, rows.schema, [tuple(r) for r in rows.collect()])
        history = history.unionByName(stored)
    real = history.where("scenario_id = 1 and currency = 'Euros'")
    monthly = real.where("data_type_id = 2").agg(F.sum("amount")).first()[0]
    assert monthly == real.where("data_type_id = 1 and period_date = 20230301").first().amount
    local = history.where("currency = 'Pesos' and data_type_id = 1 and period_date = 20230301")
    assert {r.scenario_id: r.amount for r in local.collect()} == {1: sum(months), 4: sum(months)}


def test_a_month_from_masters_to_the_table(spark):
    """Two runs: the second numbers only new labels and continues the first month's totals."""
    path = new_path(spark, "test-month")
    mapping = literal_table(spark, MAPPING_SCHEMA, [(3, "m_sum", 13, 30, "B1", 1, None), (3, "rate", 13, 1, "B1", None, None)])
    labels = {"u.1_np": "m_p", "u.1_nq": "m_q", "u.1_nfx": "rate"}
    formulas = [total("m_sum", "m_p", "m_q")]

    def rows(period, **values):
        found = []
        for product, value in values.items():
            row = list(kpi("RE", product=product, value=value))
            row[1] = str(period)
            found.append(tuple(row))
        return master(spark, *found)

    empty = master(spark)
    dimension = literal_table(spark, "kpi_id int, kpi_label string", [])
    first = Month(202301, "REAL", labels, formulas, "rate", "rate", first_month=True)
    dimension, _ = run_month(first, (rows(202301, p="1000", fx="10"), empty, empty), dimension, mapping, path)
    second = Month(202302, "REAL", labels, formulas, "rate", "rate")
    dimension, slice_rows = run_month(second, (rows(202302, p="2000", q="500", fx="20"), empty, empty), dimension, mapping, path)
    assert {r.kpi_label: r.kpi_id for r in dimension.collect()} == {"u.1_nfx": 1, "u.1_np": 2, "u.1_nq": 3}
    assert amounts(slice_rows, "concept_id", "currency", "data_type_id") == [
        (1, "Euros", 1, 20.0), (1, "Euros", 2, 20.0), (1, "Pesos", 1, 20.0), (1, "Pesos", 2, 20.0),
        (30, "Euros", 1, 0.175), (30, "Euros", 2, 0.075), (30, "Pesos", 1, 3500.0), (30, "Pesos", 2, 2500.0),
    ]


def test_cost_type_variant_keeps_the_estimate_of_the_month(spark):
    """The current estimate closes its own series there, and cost types are separate series."""
    schema = ROW + ", metric string, cost_type_id int"
    now = literal_table(spark, schema, [(*line(4, 20230201, 40), "m", 1), (*line(1, 20230201, 5), "m", 1), (*line(1, 20230201, 7), "n", 2)])
    history = literal_table(spark, schema, [(*line(1, 20230101, 10), None, 1), (*line(1, 20230101, 20), None, 2)])
    got = published_rows(now, history, 20230201, "ALL", BY_COST_TYPE).where("currency = 'Pesos'")
    assert amounts(got, "scenario_id", "cost_type_id", "metric", "data_type_id") == [
        (1, 1, "m", 1, 15.0), (1, 1, "m", 2, 5.0), (1, 2, "n", 1, 27.0), (1, 2, "n", 2, 7.0), (4, 1, "m", 1, 50.0), (4, 1, "m", 2, 40.0),
    ]


def test_described_months_add_up(spark):
    """Two metrics in one series and two dimension values: neither multiplies the next month's totals."""
    path, series = new_path(spark, "test-described"), new_path(spark, "test-series")
    dimensions = literal_table(spark, "scenario_id int, metric string, unit string", [(1, "m", "u"), (1, "m", "v"), (1, "n", "u")])
    schema = ROW + ", metric string, cost_type_id int"

    def month(date, m, n, first=False):
        now = literal_table(spark, schema, [(*line(1, date, m), "m", 1), (*line(1, date, n), "n", 1)])
        return publish(
            now, path, date, "REAL", BY_COST_TYPE, lambda df: attach_dimensions(df, dimensions, 1, "X"), series, first
        ).collect()

    month(20230101, 6000, 4000, True)
    rows = month(20230201, 2000, 3000)
    assert {r.amount for r in rows if r.currency == "Pesos" and r.data_type_id == 1} == {Decimal(15000)}
    assert {r.amount for r in rows if r.currency == "Euros" and r.data_type_id == 1} == {Decimal("1.5")}
    assert {r.amount for r in rows if r.currency == "Euros" and r.data_type_id == 2} == {Decimal("0.5")}
    assert len([r for r in rows if r.currency == "Pesos" and r.data_type_id == 2]) == 3
    again = month(20230201, 2000, 3000)
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_a_missing_table_is_no_history(spark):
    now = table_of(spark, line(1, 20230101, 1))
    with pytest.raises(AnalysisException):
        publish(now, new_path(spark, "test-missing"), 20230101, "REAL")
    with pytest.raises(ValueError):
        publish(now, new_path(spark, "test-missing"), 20230101, "REAL", describe=lambda df: df)


def labels_of(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "label string")


def test_stored_dimension_gives_every_label_one_id(spark, monkeypatch):
    path = new_path(spark, "test-dimension")
    rows = lambda df: sorted((r.id, r.label) for r in df.collect())
    assert rows(keys.store_labels(labels_of(spark, "b", "a", None, "a"), path, "id", "label")) == [(1, "a"), (2, "b")]
    assert rows(keys.store_labels(labels_of(spark, "b", "a"), path, "id", "label")) == [(1, "a"), (2, "b")]
    assert len(folders.subfolders(spark, path)) == 1  # a repeated run adds nothing
    # Another run adds labels between this run's reading and its moving.
    move = keys.move_folder

    def late(session, source, target):
        monkeypatch.setattr(keys, "move_folder", move)
        keys.store_labels(labels_of(spark, "c", "d"), path, "id", "label")
        return move(session, source, target)

    monkeypatch.setattr(keys, "move_folder", late)
    got = rows(keys.store_labels(labels_of(spark, "a", "d", "e"), path, "id", "label"))
    assert got == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")] and rows(keys.stored_dimension(spark, path, "id", "label")) == got


def test_stages_go_after_success_only(spark):
    with stage_scope(spark):
        done = stage_rows(spark.range(3), "test-scope")
        assert done.count() == 3
        path = done.inputFiles()[0].rsplit("/", 1)[0]
    assert not os.path.exists(path.removeprefix("file://"))
    with pytest.raises(ValueError):
        with stage_scope(spark):
            kept = stage_rows(spark.range(3), "test-scope")
            raise ValueError
    assert kept.count() == 3


def test_only_wanted_formulas_enter_the_plan(spark):
    formulas = [
        total("a", "x"), total("b", "a", "y"), total("a", "a", "a", redefine=True), total("c", "a"), total("unused", "b"), ratio("r", "c", "b"),
        total("x", "y", redefine=True),
    ]
    assert [f.name for f in needed(formulas, ["c"])] == ["a", "a", "c"]
    assert [f.name for f in needed(formulas, ["b"])] == ["a", "b"]
    assert [f.name for f in needed(formulas, ["x"])] == ["x"] and needed(formulas, ["y"]) == []
    df = spark.createDataFrame([(Decimal(3), Decimal(5), Decimal(7), 1)], "x decimal(24,10), y decimal(24,10), z decimal(24,10), scenario_id int")
    every = apply_formulas(df, formulas).first().asDict()
    for wanted in (["c"], ["r", "b"], ["x", "r"], []):
        got = apply_formulas(df, formulas, wanted=wanted)
        assert got.columns == list(dict.fromkeys([*df.columns, *wanted]))
        assert {k: v for k, v in got.first().asDict().items() if k in wanted} == {k: every[k] for k in wanted}
    assert apply_formulas(df, formulas, wanted=["c"]).first()["x"] == 3  # its new definition is not asked for
    plan = apply_formulas(df, formulas, wanted=["r"]).select("r")._jdf.queryExecution().optimizedPlan().toString()
    assert "unused" not in plan and "z#" not in plan.split("LocalRelation")[0].split("LogicalRDD")[0]
    with pytest.raises(ValueError, match="nothing defines"):
        apply_formulas(df, formulas, wanted=["nope"])


def test_218_formulas_run_as_generated_code(spark):
    """More formulas than the business has, several levels deep, where a failed compilation would be an error."""
    base = [f"b{k}" for k in range(213)]
    df = spark.range(0, 2_000, 1, 4).select(F.lit(1).alias("scenario_id"), *[(F.col("id") + k).cast("decimal(24,10)").alias(c) for k, c in enumerate(base)])
    formulas, names = [], list(base)
    for k in range(218):
        operands = [names[(7 * k + 31 * j) % len(names)] for j in range(2 + k % 9)]
        formulas.append(ratio(f"f{k}", *operands[:2]) if k % 10 == 9 else total(f"f{k}", *operands))
        names.append(f"f{k}")
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        apply_formulas(df, formulas).write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.unset("spark.sql.codegen.factoryMode")
        spark.conf.unset("spark.sql.codegen.fallback")
