"""Joins. Broadcasts are left to Spark's own size check; big sides meet by shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def map_join(
    left: DataFrame, right: DataFrame, keys: Mapping[str, str], bring: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join by a key map ``left -> right`` and bring the named columns of the right side."""
    wanted = [F.col(r).alias(f"__key_{i}") for i, r in enumerate(keys.values())]
    small = right.select(*wanted, *bring)
    condition = reduce(and_, [left[name] == small[f"__key_{i}"] for i, name in enumerate(keys)])
    return left.join(small, condition, how).drop(*[f"__key_{i}" for i in range(len(keys))])


def computed_key_join(left: DataFrame, right: DataFrame, key: Column, right_key: str, how: str = "left") -> DataFrame:
    """Left rows matched by an expression over their columns; the right key column is kept."""
    keyed = left.withColumn("__label", key)
    return keyed.join(right, keyed["__label"] == right[right_key], how).drop("__label")


def anti_join_trimmed(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows whose trimmed key is absent on the right; a null key is never present."""
    present = right.select(F.trim(F.col(key)).alias("__present"))
    return left.join(present, F.trim(left[key]) == present["__present"], "left_anti")


def full_outer_left_keys(left: DataFrame, right: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Full outer join that keeps the left keys only; they are null for rows found on the right.

    A left join and the right rows that meet nothing, in place of the one join whose skewed
    partitions Spark does not split: a hot key on either side is dealt over tasks, so no side needs
    to be grouped before. Null keys meet nothing. Both sides are evaluated twice; store what is dear.
    """
    condition = reduce(and_, [left[a] == right[b] for a, b in keys.items()])
    rest = [c for c in right.columns if c not in keys.values()]
    joined = reduce(lambda d, b: d.drop(right[b]), keys.values(), left.join(right, condition, "left"))
    held = left.select(*[F.col(a).alias(f"__key_{i}") for i, a in enumerate(keys)]).distinct()
    met = reduce(and_, [right[b] == held[f"__key_{i}"] for i, b in enumerate(keys.values())])
    only = right.join(held, met, "left_anti")
    none = [F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns]
    return joined.union(only.select(*none, *rest))


def attach_scalar(df: DataFrame, scalar: DataFrame, column: str) -> DataFrame:
    """Put the only row of ``scalar`` beside every row; without a row nothing is left.

    A scalar subquery replaces the cross product: it is evaluated once, and more than one row is an
    error instead of a multiplication of the data.
    """
    boxed = scalar.select(F.struct(F.col(column).alias("value"))).scalar()
    return df.withColumn("__box", boxed).where("__box is not null").withColumn(column, F.col("__box.value")).drop("__box")


def spine_join(spine: DataFrame, df: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Every spine row with the matching data rows, or with nulls."""
    condition = reduce(and_, [spine[a] == df[b] for a, b in keys.items()])
    joined = spine.join(df, condition, "left")
    return reduce(lambda d, b: d.drop(df[b]), keys.values(), joined)


def join_keys_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which two null keys agree; the left keys are kept."""
    names = {k: f"__r_{k}" for k in keys}
    renamed = right.withColumnsRenamed(names)
    condition = reduce(and_, [left[k].eqNullSafe(renamed[name]) for k, name in names.items()])
    return left.join(renamed, condition, how).drop(*names.values())
