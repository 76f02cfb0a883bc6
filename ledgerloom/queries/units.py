"""Unit conversion of order-line measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators.aggregates import reconciled_write
from ledgerloom.plans.units import conversion_factors, convert_units
from ledgerloom.queries.base import _sql_value, table
from ledgerloom.queries.registry import query
from ledgerloom.session import new_path
from ledgerloom.sources.sinks import overwrite_table
from ledgerloom.sources.tables import literal_table

_CLASS = "STREAM"
_PRESENTATION = [
    ("STREAM", "quantity", "VOLUME", "ARG"),
    ("STREAM", "quantity", "VOLUME", "BRA"),
    ("STREAM", "quantity", "VOLUME", "PER"),
    ("STREAM", "price", "VALUE", "ARG"),
    ("STREAM", "price", "VALUE", "BRA"),
    ("OTHER", "tax", "VALUE", "ARG"),
]
_SETUP = [
    ("VOLUME", "m3", "Y", "N", "ARG"),
    ("VOLUME", "bbl", "N", "Y", "ARG"),
    ("VOLUME", "bbl", "Y", "Y", "BRA"),
    ("VOLUME", "l", "N", "Y", "BRA"),
    ("VOLUME", "m3", "Y", "N", "PER"),
    ("VALUE", "usd", "Y", "Y", "ARG"),
    ("VALUE", "kusd", "Y", "N", "BRA"),
    ("VALUE", "eur", "N", "N", "BRA"),
]
_CONVERSION = [
    ("m3", "bbl", 6.2898, 0.0),
    ("m3", "l", 1000.0, 0.0),
    ("bbl", "m3", 0.158987, 0.25),
    ("bbl", "bbl", 1.0, None),
    ("usd", "kusd", 0.001, 0.5),
]
_WANTED = [("quantity", "m3"), ("quantity", "bbl"), ("quantity", "l"), ("price", "usd"), ("price", "kusd")]


def _values(name, columns, rows):
    return f"{name} AS (SELECT * FROM (VALUES " + ", ".join(
        "(" + ", ".join(_sql_value(v) for v in row) + ")" for row in rows
    ) + f") AS v({columns}))"


_BU_SQL = "CASE {0} WHEN 'ARG' THEN '1' WHEN 'BRA' THEN '2' WHEN 'RNAS' THEN '3' ELSE '4' END"
_LINE_SQL = """fact AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS quantity, l_extendedprice AS price,
    CASE l_returnflag WHEN 'R' THEN 'ARG' WHEN 'A' THEN 'BRA' ELSE 'PER' END AS id_bu FROM lineitem)"""
_CONFIG_SQL = f"""{_values("presentation", "class_name, attribute_name, uom, id_bu", _PRESENTATION)},
    {_values("setup", "measurement_type, unit, db_unit, view_unit, id_bu", _SETUP)},
    {_values("conversion", "from_unit, to_unit, mult_fact, add_numb", _CONVERSION)},
    shown AS (SELECT * FROM presentation WHERE class_name = '{_CLASS}'),
    database_units AS (SELECT DISTINCT measurement_type, unit, {_BU_SQL.format("id_bu")} AS bu FROM setup WHERE db_unit = 'Y'),
    wanted AS (SELECT DISTINCT attribute_name, unit FROM shown JOIN setup ON uom = measurement_type WHERE db_unit = 'Y' OR view_unit = 'Y'),
    factors AS (SELECT s.id_bu, s.attribute_name, w.unit AS to_unit,
      CASE WHEN d.unit = w.unit AND mult_fact IS NULL THEN 1 ELSE CAST(mult_fact AS DOUBLE) END AS factor,
      CASE WHEN d.unit = w.unit AND add_numb IS NULL THEN 0 ELSE CAST(add_numb AS DOUBLE) END AS shift
      FROM shown AS s LEFT JOIN database_units AS d ON d.measurement_type = s.uom AND d.bu = {_BU_SQL.format("s.id_bu")}
      JOIN wanted AS w ON w.attribute_name = s.attribute_name LEFT JOIN conversion ON from_unit = d.unit AND conversion.to_unit = w.unit)"""
_PAIR_JOINS = " ".join(
    f"LEFT JOIN factors AS p{i} ON p{i}.id_bu = fact.id_bu AND p{i}.attribute_name = '{a}' AND p{i}.to_unit = '{u}'"
    for i, (a, u) in enumerate(_WANTED)
)


def _config(spark):
    return (
        literal_table(spark, "class_name string, attribute_name string, uom string, id_bu string", _PRESENTATION),
        literal_table(
            spark, "measurement_type string, unit string, db_unit string, view_unit string, id_bu string", _SETUP
        ),
        literal_table(spark, "from_unit string, to_unit string, mult_fact double, add_numb double", _CONVERSION),
    )


def _lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    bu = F.when(F.col("l_returnflag") == "R", "ARG").when(F.col("l_returnflag") == "A", "BRA").otherwise("PER")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"), bu.alias("id_bu"), F.col("l_returnflag").alias("flag"),
    )


def _converted(fact, *more):
    factors = conversion_factors(*_config(fact.sparkSession), _CLASS)
    return convert_units(fact, factors, ["l_orderkey", "l_linenumber", "l_partkey", "id_bu", *more], _WANTED)


@query(
    "unit_conversion",
    f"""WITH {_LINE_SQL}, {_CONFIG_SQL} SELECT fact.l_orderkey, fact.l_linenumber, fact.l_partkey, fact.id_bu,
    {", ".join(f"round({a} * p{i}.factor + p{i}.shift, 6) AS {a}_{u}" for i, (a, u) in enumerate(_WANTED))}
    FROM fact {_PAIR_JOINS}""",
)
def unit_conversion(spark, sf_dir):
    rows = _converted(_lines(spark, sf_dir))
    rounded = {f"{a}_{u}": F.round(f"{a}_{u}", 6) for a, u in _WANTED}
    return rows.withColumns(rounded)


@query(
    "unit_conversion_report",
    """SELECT CAST(l_returnflag AS VARCHAR) AS flag, count(*) AS stored, (SELECT count(*) FROM lineitem) AS rows_read,
    (SELECT count(*) FROM lineitem) AS rows_written, true AS agree FROM lineitem GROUP BY 1""",
)
def unit_conversion_report(spark, sf_dir):
    """The conversion written as a table, with the counts that its one write observed."""
    path = new_path(spark, "converted")
    lines = _lines(spark, sf_dir)
    counts = reconciled_write(lines, lambda rows: _converted(rows, "flag"), lambda rows: overwrite_table(rows, path))
    stored = spark.read.parquet(path).groupBy("flag").agg(F.count("*").alias("stored"))
    return stored.withColumns({name: F.lit(value) for name, value in counts.items()})
