"""Sinks: every query writes into a folder of its own and returns what is stored afterwards."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerloom.functions.scenarios import published_scenario_id, scenario_ids
from ledgerloom.functions.types import MONEY
from ledgerloom.queries.base import KPI_FACT_SQL, kpi_fact, table
from ledgerloom.queries.registry import query
from ledgerloom.session import new_path, shared_dir
from ledgerloom.sources.configured import parse_records, read_configured, write_configured
from ledgerloom.sources.sinks import (
    append_rows,
    overwrite_partitions,
    overwrite_table,
    replace_slice,
    stage_boundary,
)
from ledgerloom.sources.tables import create_table_from, read_slice

_PERIOD = 199806
_COLUMNS = ["period", "scenario_id", "unit", "value"]
_PUBLISHED_ID_SQL = "CASE scenario WHEN 'RE' THEN 1 WHEN 'PA' THEN 2 WHEN 'UPA' THEN 3 ELSE 4 END"
_BASE_SQL = f"""{KPI_FACT_SQL}, base AS (SELECT period, {_PUBLISHED_ID_SQL} AS scenario_id, unit, CAST(sum(value) AS DECIMAL(24,10)) AS value
    FROM kpi_fact GROUP BY 1, 2, 3)"""


def _base(spark, sf_dir):
    fact = kpi_fact(spark, sf_dir).withColumn("scenario_id", published_scenario_id("scenario"))
    summed = fact.groupBy("period", "scenario_id", "unit").agg(F.sum("value").cast(MONEY).alias("value"))
    # Stored once: the queries write it and then write parts of it again.
    path = new_path(spark, "base")
    summed.select(*_COLUMNS).write.parquet(path)
    return spark.read.parquet(path)


def _doubled(df):
    return df.withColumn("value", (F.col("value") * 2).cast(MONEY))


@query(
    "partition_overwrite",
    f"""WITH {_BASE_SQL} SELECT period, scenario_id, unit, CAST(CASE WHEN period = {_PERIOD} THEN value * 2 ELSE value END AS DECIMAL(24,10)) AS value FROM base""",
)
def partition_overwrite(spark, sf_dir):
    path, base = new_path(spark, "overwrite"), _base(spark, sf_dir)
    overwrite_partitions(base, path, ["period"])
    overwrite_partitions(_doubled(base.where(F.col("period") == _PERIOD)), path, ["period"])
    return spark.read.parquet(path).select(*_COLUMNS)


@query(
    "partition_overwrite_two_keys",
    f"""WITH {_BASE_SQL} SELECT period, scenario_id, unit, CAST(CASE WHEN period = {_PERIOD} AND scenario_id = 2 THEN value * 2 ELSE value END AS DECIMAL(24,10)) AS value FROM base""",
)
def partition_overwrite_two_keys(spark, sf_dir):
    path, base, keys = new_path(spark, "overwrite"), _base(spark, sf_dir), ["period", "scenario_id"]
    overwrite_partitions(base, path, keys)
    overwrite_partitions(_doubled(base.where((F.col("period") == _PERIOD) & (F.col("scenario_id") == 2))), path, keys)
    return spark.read.parquet(path).select(*_COLUMNS)


@query(
    "replace_slice",
    f"""WITH {_BASE_SQL} SELECT period, scenario_id, unit, value FROM base WHERE NOT (period = {_PERIOD} AND scenario_id IN (2, 3))
    UNION ALL SELECT period, scenario_id, unit, CAST(value * 2 AS DECIMAL(24,10)) FROM base WHERE period = {_PERIOD} AND scenario_id = 2""",
)
def replace_slice_query(spark, sf_dir):
    """The new rows hold nothing for one of the two scenarios, whose slice must end up empty."""
    path, base = new_path(spark, "slices"), _base(spark, sf_dir)
    overwrite_partitions(base, path, ["period", "scenario_id"])
    new = _doubled(base.where((F.col("period") == _PERIOD) & (F.col("scenario_id") == 2)))
    replace_slice(new, path, "period", _PERIOD, "scenario_id", scenario_ids("PA-UPA", "published"))
    return spark.read.parquet(path).select(*_COLUMNS)


@query(
    "replace_period",
    f"""WITH {_BASE_SQL} SELECT period, scenario_id, unit, value FROM base WHERE period <> {_PERIOD}
    UNION ALL SELECT period, scenario_id, unit, CAST(value * 2 AS DECIMAL(24,10)) FROM base WHERE period = {_PERIOD} AND scenario_id <> 4""",
)
def replace_period(spark, sf_dir):
    path, base = new_path(spark, "slices"), _base(spark, sf_dir)
    overwrite_partitions(base, path, ["period", "scenario_id"])
    new = _doubled(base.where((F.col("period") == _PERIOD) & (F.col("scenario_id") != 4)))
    replace_slice(new, path, "period", _PERIOD, "scenario_id", scenario_ids("ALL", "published"))
    return spark.read.parquet(path).select(*_COLUMNS)


@query(
    "stage_boundary",
    f"WITH {_BASE_SQL} SELECT period, scenario_id, unit, value FROM base WHERE period = {_PERIOD} AND scenario_id IN (1, 2)",
)
def stage_boundary_query(spark, sf_dir):
    wanted = {"period": _PERIOD, "scenario_id": [1, 2]}
    stored = stage_boundary(_base(spark, sf_dir), new_path(spark, "stage"), ["period", "scenario_id"], wanted)
    return stored.select(*_COLUMNS)


@query(
    "append_sink",
    f"WITH {_BASE_SQL} SELECT * FROM base UNION ALL SELECT * FROM base WHERE period = {_PERIOD}",
)
def append_sink(spark, sf_dir):
    path, base = new_path(spark, "append"), _base(spark, sf_dir)
    append_rows(base, path, ["period"])
    append_rows(base.where(F.col("period") == _PERIOD), path, ["period"])
    return spark.read.parquet(path).select(*_COLUMNS)


@query(
    "overwrite_table",
    f"WITH {_BASE_SQL} SELECT * FROM base WHERE scenario_id = 1",
)
def overwrite_table_query(spark, sf_dir):
    path, base = new_path(spark, "table"), _base(spark, sf_dir)
    overwrite_table(base, path)
    overwrite_table(base.where(F.col("scenario_id") == 1), path)
    return spark.read.parquet(path).select(*_COLUMNS)


@query(
    "config_source",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_nationkey <> 3",
)
def config_source(spark, sf_dir):
    """Read by one record, write by another, read the target back."""
    roots = {"given": sf_dir, "work": new_path(spark, "configured")}
    source, target = parse_records(
        """[{"linked_service": "lake", "container": "given", "path": "customer.parquet", "format": "parquet"},
            {"linked_service": "lake", "container": "work", "path": "/out", "format": "csv",
             "format_options": {"header": "true", "sep": ";"}}]"""
    )
    customers = read_configured(spark, source, roots).where(F.col("c_nationkey") != 3)
    write_configured(customers.select("c_custkey", "c_name", "c_mktsegment"), target, roots)
    stored = read_configured(spark, target, roots)
    return stored.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query(
    "create_insert",
    "SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS name, lower(replace(c_name, '#', '')) || '@example.com' AS email FROM customer",
)
def create_insert(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    users = customers.select(
        F.col("c_custkey").cast("int").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower(F.translate("c_name", "#", "")), F.lit("@example.com")).alias("email"),
    )
    name = f"users_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/ledgerloom/{name}"
    schema = create_table_from(users, name, path).schema
    spark.sql(f"DROP TABLE {name}")  # its files stay where they are
    return spark.read.schema(schema).parquet(path)


@query(
    "slice_by_partition",
    f"WITH {_BASE_SQL} SELECT unit, value FROM base WHERE period = {_PERIOD} AND scenario_id = 4",
)
def slice_by_partition(spark, sf_dir):
    """A slice of a partitioned table: only its folders are read."""
    path = new_path(spark, "sliced")
    overwrite_partitions(_base(spark, sf_dir), path, ["period", "scenario_id"])
    return read_slice(spark, path, {"period": _PERIOD, "scenario_id": 4}).select("unit", "value")
