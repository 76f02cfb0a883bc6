"""Unit conversion of measured attributes by configuration tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import affine, code_of, unit_factor
from ledgerloom.operators.joins import map_join

# Business units and the codes used by the unit setup; anything else is 4.
BUSINESS_UNIT_CODES = {"ARG": "1", "BRA": "2", "RNAS": "3"}
OTHER_BUSINESS_UNIT = "4"


def business_unit_code(column: str | Column) -> Column:
    return code_of(column, BUSINESS_UNIT_CODES, OTHER_BUSINESS_UNIT)


def conversion_factors(
    presentation: DataFrame, setup: DataFrame, conversion: DataFrame, class_name: str
) -> DataFrame:
    """Factor and offset per (business unit, attribute, wanted unit).

    An attribute is shown in every unit that is a database or view unit of its measurement type,
    converted from the database unit of the business unit. Equal units without a factor need none.
    """
    shown = presentation.where(F.col("class_name") == class_name)
    coded = setup.withColumn("unit_bu", business_unit_code("id_bu"))
    database = coded.where("db_unit = 'Y'").select("measurement_type", "unit_bu", F.col("unit").alias("from_unit"))
    wanted = (
        map_join(shown, setup, {"uom": "measurement_type"}, ["db_unit", "view_unit", "unit"], "inner")
        .where("db_unit = 'Y' OR view_unit = 'Y'")
        .select("attribute_name", F.col("unit").alias("to_unit"))
        .distinct()
    )
    attributes = shown.select("attribute_name", "uom", "id_bu").withColumn("bu_code", business_unit_code("id_bu"))
    attributes = map_join(
        attributes, database.distinct(), {"uom": "measurement_type", "bu_code": "unit_bu"}, ["from_unit"]
    )
    fanned = map_join(attributes, wanted, {"attribute_name": "attribute_name"}, ["to_unit"], "inner")
    factors = conversion.select("from_unit", "to_unit", "mult_fact", "add_numb").distinct()
    found = map_join(
        fanned, factors, {"from_unit": "from_unit", "to_unit": "to_unit"}, ["mult_fact", "add_numb"]
    )
    return found.select(
        "id_bu",
        "attribute_name",
        "to_unit",
        unit_factor("mult_fact", "from_unit", "to_unit", 1).alias("factor"),
        unit_factor("add_numb", "from_unit", "to_unit", 0).alias("offset"),
    )


def convert_units(
    fact: DataFrame, factors: DataFrame, fixed: Sequence[str], wanted: Sequence[tuple[str, str]]
) -> DataFrame:
    """One row per fact row with a column ``attribute_unit`` per wanted pair.

    Instead of turning the fact into rows and back, which would shuffle it several times over, the
    factors are turned into one row per business unit and sent to the tasks of the fact, which keeps
    its place. Spark's size check cannot see how few they are: it multiplies the sizes of the
    configuration tables, and would shuffle the fact into as many tasks as there are business units.
    A pair without a factor is null. Factor and offset of a pair are one value: several of them for
    a business unit, or a configured pair that is not wanted, are an error when the query runs.
    """
    named = F.concat_ws(" in ", "attribute_name", "to_unit")
    asked = F.lit(False)
    for attribute, unit in wanted:
        asked = asked | ((F.col("attribute_name") == attribute) & (F.col("to_unit") == unit))
    aggregates = [F.max(F.when(~asked, named)).alias("__unwanted")]
    for attribute, unit in wanted:
        chosen = (F.col("attribute_name") == attribute) & (F.col("to_unit") == unit) & F.col("factor").isNotNull()
        both = F.when(chosen, F.struct("factor", "offset"))
        aggregates += [F.min(both).alias(f"__a_{attribute}_{unit}"), F.max(both).alias(f"__b_{attribute}_{unit}")]
    found = factors.groupBy("id_bu").agg(*aggregates)

    def single(attribute: str, unit: str) -> Column:
        low, high = F.col(f"__a_{attribute}_{unit}"), F.col(f"__b_{attribute}_{unit}")
        several = F.concat(F.lit(f"several factors for {attribute} in {unit} at "), F.coalesce("id_bu", F.lit("no unit")))
        missing = F.concat(F.lit("configured but not wanted: "), F.col("__unwanted"))
        checked = F.when(F.col("__unwanted").isNotNull(), F.raise_error(missing))
        return checked.when(~low.eqNullSafe(high), F.raise_error(several)).otherwise(low)

    per_unit = found.select("id_bu", *[single(a, u).alias(f"__p_{a}_{u}") for a, u in wanted])
    joined = fact.join(F.broadcast(per_unit), "id_bu", "left")
    return joined.select(
        *fixed,
        *[
            affine(attribute, F.col(f"__p_{attribute}_{unit}.factor"), F.col(f"__p_{attribute}_{unit}.offset")).alias(f"{attribute}_{unit}")
            for attribute, unit in wanted
        ],
    )
