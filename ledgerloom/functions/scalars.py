"""Scalar column helpers. All of them stay inside Spark's built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ledgerloom.functions.types import MONEY


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def code_of(column: str | Column, codes: dict, default=None) -> Column:
    """CASE mapping ``value -> code`` with a default for everything else, nulls included."""
    source = _col(column)
    result = None
    for value, code in codes.items():
        result = (F if result is None else result).when(source == F.lit(value), F.lit(code))
    return F.lit(default) if result is None else result.otherwise(F.lit(default))


def null_to_zero(column: str | Column, dtype: DataType = MONEY) -> Column:
    return F.coalesce(_col(column), F.lit(0).cast(dtype))


# Each decimal addition widens the type by a digit; beyond 38 digits decimals would be cut off, so a
# running sum returns to its type after this many operands.
OPERANDS_AT_ONCE = 10


def signed_sum(plus: Sequence[str], minus: Sequence[str] = (), dtype: DataType = MONEY) -> Column:
    """Null-safe ``a + b - c``; a missing operand counts as zero."""
    operands = [null_to_zero(name, dtype) for name in plus] + [-null_to_zero(name, dtype) for name in minus]
    if not operands:
        raise ValueError("a signed sum needs at least one operand")
    total = operands[0]
    for number, operand in enumerate(operands[1:], start=1):
        total = (total.cast(dtype) if number % OPERANDS_AT_ONCE == 0 else total) + operand
    return total.cast(dtype)


def safe_ratio(numerator: str | Column, denominator: str | Column, dtype: DataType = MONEY) -> Column:
    """Null-safe ratio; a zero or missing divisor gives null."""
    return F.try_divide(null_to_zero(numerator, dtype), null_to_zero(denominator, dtype)).cast(dtype)


def composite_label(unit: str | Column, name: str | Column, product: str | Column) -> Column:
    """``unit_name`` plus the product if there is one; a null unit or name makes the label null."""
    return F.concat(_col(unit), F.lit("_"), _col(name), F.coalesce(_col(product), F.lit("")))


def clean_unit(column: str | Column) -> Column:
    """Decimal comma to point inside a business-unit text; a single character needs no pattern."""
    return F.translate(_col(column), ",", ".")


def strip_pattern(column: str | Column, pattern: str) -> Column:
    return F.regexp_replace(_col(column), pattern, "")


def iso_to_blank(column: str | Column) -> Column:
    """ISO time text with the ``T`` separator replaced by a blank."""
    return F.translate(_col(column), "T", " ")


def null_text(column: str | Column, marker: str = "NULL") -> Column:
    """The text ``NULL`` stands for a missing value."""
    return F.nullif(_col(column), F.lit(marker))


def affine(value: str | Column, factor: str | Column, offset: str | Column) -> Column:
    return _col(value) * _col(factor) + _col(offset)


def unit_factor(factor: str | Column, from_unit: str | Column, to_unit: str | Column, identity: int) -> Column:
    """Conversion factor; identity only where both units agree and no factor is given."""
    missing = _col(factor).isNull() & (_col(from_unit) == _col(to_unit))
    return F.when(missing, F.lit(identity)).otherwise(_col(factor))


def adjustment(scenario: str | Column, scenario_id: int, computed: str | Column, reported: str | Column) -> Column:
    """Difference to the reported figure, for one scenario only."""
    return F.when(_col(scenario) == scenario_id, _col(computed) - _col(reported)).otherwise(F.lit(0)).cast(MONEY)


def adjusted(computed: str | Column, reported: str | Column, difference: str | Column) -> Column:
    """The computed figure moved onto the reported one, where a figure was reported."""
    return (
        F.when(_col(reported).isNull(), _col(computed)).otherwise(_col(computed) - _col(difference)).cast(MONEY)
    )
