"""Tables: scans of slices, literal tables, empty tables, demo tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, DecimalType, StructType

from ledgerloom.functions.predicates import all_equal


def read_slice(spark: SparkSession, path: str, wanted: Mapping[str, object] | None = None, fmt: str = "parquet") -> DataFrame:
    """Scan with the slice filter directly above it: partition columns prune, others push down."""
    df = spark.read.format(fmt).load(path)
    return df.where(all_equal(wanted)) if wanted else df


def read_table(spark: SparkSession, name: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """A catalogue table, or a JDBC table when connection options are given."""
    if options is None:
        return spark.table(name)
    return spark.read.format("jdbc").options(**options).option("dbtable", name).load()


_ARROW_TYPES = {
    "string": pa.string(),
    "int": pa.int32(),
    "bigint": pa.int64(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "date": pa.date32(),
    "timestamp": pa.timestamp("us", "UTC"),
    "timestamp_ntz": pa.timestamp("us"),
}


def _arrow_type(kind: DataType) -> pa.DataType:
    if isinstance(kind, DecimalType):
        return pa.decimal128(kind.precision, kind.scale)
    return _ARROW_TYPES[kind.simpleString()]


def literal_table(spark: SparkSession, schema: str | StructType, rows: Sequence[Sequence]) -> DataFrame:
    """Rows written in the program as a local relation, so that Spark knows its exact size."""
    struct = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(struct.fields)
    arrays = [pa.array(list(c), type=_arrow_type(f.dataType)) for c, f in zip(columns, struct.fields, strict=True)]
    table = pa.Table.from_arrays(arrays, names=[f.name for f in struct.fields])
    return spark.createDataFrame(table, schema=struct)


def neutral_table(spark: SparkSession) -> DataFrame:
    """No columns and no rows: the identity of a union by name with missing columns allowed."""
    return spark.createDataFrame([], StructType([]))


def typed_empty(df: DataFrame) -> DataFrame:
    return df.limit(0)


def create_table_from(df: DataFrame, name: str, path: str) -> DataFrame:
    """Create an external table with the columns of ``df`` and insert its rows."""
    spark = df.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING parquet LOCATION '{path}'")
    df.write.insertInto(name)
    return spark.table(name)
