"""Metric formulas as data, applied together over wide rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ledgerloom.functions.scalars import OPERANDS_AT_ONCE
from ledgerloom.functions.types import MONEY


@dataclass(frozen=True)
class Formula:
    """``kind`` is ``sum`` (plus and minus), ``ratio``, ``adjustment`` or ``adjusted``.

    ``operands`` of a ratio are numerator and divisor; of an adjustment the computed and reported
    metrics; of an adjusted metric additionally the adjustment.
    """

    name: str
    kind: str
    operands: tuple[str, ...]
    minus: tuple[str, ...] = ()
    scenario_id: int | None = None
    redefine: bool = False
    inputs: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "inputs", self.operands + self.minus)


def total(name: str, *plus: str, minus: Sequence[str] = (), redefine: bool = False) -> Formula:
    return Formula(name, "sum", tuple(plus), tuple(minus), redefine=redefine)


def ratio(name: str, numerator: str, divisor: str, redefine: bool = False) -> Formula:
    return Formula(name, "ratio", (numerator, divisor), redefine=redefine)


def difference_to_reported(name: str, computed: str, reported: str, scenario_id: int) -> Formula:
    return Formula(name, "adjustment", (computed, reported), scenario_id=scenario_id)


def moved_to_reported(name: str, computed: str, reported: str, difference: str) -> Formula:
    return Formula(name, "adjusted", (computed, reported, difference))


_TYPE = MONEY.simpleString()


def _or_zero(name: str) -> str:
    return f"coalesce(`{name}`, cast(0 as {_TYPE}))"


def _expression(formula: Formula, names: Sequence[str], scenario: str) -> str:
    """SQL text of a formula; one text per metric is much cheaper to build than a tree of columns."""
    if formula.kind == "sum":
        count = len(formula.operands)
        text = _or_zero(names[0]) if count else f"cast(0 as {_TYPE})"
        for number, name in enumerate(names[1 if count else 0 :], start=1):
            if number % OPERANDS_AT_ONCE == 0:
                text = f"cast({text} as {_TYPE})"
            text += f" {'+' if number < count else '-'} {_or_zero(name)}"
    elif formula.kind == "ratio":
        text = f"try_divide({_or_zero(names[0])}, {_or_zero(names[1])})"
    elif formula.kind == "adjustment":
        text = f"CASE WHEN `{scenario}` = {formula.scenario_id} THEN `{names[0]}` - `{names[1]}` ELSE 0 END"
    elif formula.kind == "adjusted":
        text = f"CASE WHEN `{names[1]}` IS NULL THEN `{names[0]}` ELSE `{names[0]}` - `{names[2]}` END"
    else:
        raise ValueError(f"unknown kind of formula: {formula.kind}")
    return f"cast({text} as {_TYPE})"


def needed(formulas: Sequence[Formula], wanted: Sequence[str]) -> list[Formula]:
    """The formulas that the wanted metrics depend on, in order.

    The dependency graph is walked from the last definition back: a definition is needed if a metric
    wanted after it, or an operand of a needed formula after it, means just this one.
    """
    open_, kept = set(wanted), []
    for formula in reversed(formulas):
        if formula.name in open_:
            open_.discard(formula.name)  # earlier definitions of this name mean something else
            open_ |= set(formula.inputs)
            kept.append(formula)
    return kept[::-1]


def apply_formulas(
    df: DataFrame, formulas: Sequence[Formula], scenario: str = "scenario_id", wanted: Sequence[str] | None = None
) -> DataFrame:
    """Add all metrics with one selection whose expressions refer to each other by name.

    Formulas apply in order: an operand means its latest definition so far. Defining a name twice
    needs ``redefine=True``; an operand that is neither a column nor defined earlier is an error,
    which also rules out cycles. Spark stacks one projection per dependency level, where a chain of
    added columns would be analysed once per metric. With ``wanted`` only these metrics are added,
    and only formulas that they depend on enter the plan.
    """
    current = {c: c for c in df.columns}
    selected = []
    use = None if wanted is None else {id(f) for f in needed(formulas, wanted)}
    for number, formula in enumerate(formulas):
        if formula.name in current and not formula.redefine:
            raise ValueError(f"metric defined twice: {formula.name}")
        unknown = [n for n in formula.inputs if n not in current]
        if unknown:
            raise ValueError(f"{formula.name} uses metrics not defined before it: {unknown}")
        names = [current[n] for n in formula.inputs]
        stored = f"__v{number}_{formula.name}" if formula.name in current else formula.name
        if use is None or id(formula) in use:
            selected.append(f"{_expression(formula, names, scenario)} AS `{stored}`")
        current[formula.name] = stored
    unknown = [n for n in wanted or () if n not in current]
    if unknown:
        raise ValueError(f"wanted metrics that nothing defines: {unknown}")
    result = df.selectExpr("*", *selected)
    order = dict.fromkeys([*df.columns, *([f.name for f in formulas] if wanted is None else wanted)])
    # A column that an unwanted formula defines anew keeps its own value.
    held = set(result.columns)
    return result.selectExpr(*[f"`{current[n] if current[n] in held else n}` AS `{n}`" for n in order])
