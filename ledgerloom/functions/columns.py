"""Projections: typing, renaming, guaranteed columns, dictionaries."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ledgerloom.functions.types import MONEY


def typed_projection(df: DataFrame, spec: Sequence[tuple[str, str, DataType | str]]) -> DataFrame:
    """``(source column, name, type)`` triples as one projection.

    A value that does not fit its type becomes null, it does not end the run.
    """
    return df.select(*[F.col(source).try_cast(dtype).alias(name) for source, name, dtype in spec])


def ensure_columns(df: DataFrame, names: Iterable[str], default=None, dtype: DataType | str = MONEY) -> DataFrame:
    """Add the missing columns in one projection; names compare without regard to case."""
    present = {c.upper() for c in df.columns}
    missing = []
    for name in names:
        if name.upper() not in present:
            present.add(name.upper())
            missing.append(F.lit(default).cast(dtype).alias(name))
    return df.select("*", *missing) if missing else df


def all_nullable(df: DataFrame) -> DataFrame:
    """Same rows with every top-level column nullable, without leaving the plan."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return df.select(*[F.when(c.isNotNull(), c).alias(n) for c, n in zip(columns, df.columns, strict=True)])


def dictionary_projection(
    df: DataFrame, keys: Sequence[str], labels: Mapping[str, str], dtype: DataType | str = MONEY
) -> DataFrame:
    """Pivoted labels to short metric codes; labels absent from the data become null."""
    known = {c.upper(): c for c in df.columns}
    columns = []
    for label, code in labels.items():
        found = known.get(label.upper())
        source = F.lit(None) if found is None else F.col(f"`{found}`")
        columns.append(source.cast(dtype).alias(code))
    return df.select(*keys, *columns)
