from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.columns import typed_projection
from ledgerloom.operators.aggregates import reconciled_write
from ledgerloom.session import new_path, shared_dir
from ledgerloom.sources import configured
from ledgerloom.sources.folders import partition_folders
from ledgerloom.sources.masters import catalogue_measures, load_master
from ledgerloom.sources.sinks import jdbc_options, overwrite_partitions, replace_slice, stage_boundary
from ledgerloom.sources.snapshots import latest_load, read_latest, read_snapshot
from ledgerloom.sources.tables import create_table_from, literal_table, read_slice


@pytest.fixture(scope="module")
def snapshots(spark):
    path = new_path(spark, "test-snapshots")
    df = spark.createDataFrame([("20230101-202301", 1), ("20230205-202301", 2), ("20230301-202303", 3)], "load string, v int")
    overwrite_partitions(df, path, ["load"])
    return path


def test_snapshot_takes_the_greatest_of_its_period(spark, snapshots):
    assert [r.v for r in read_snapshot(spark, snapshots, "load", "202301").collect()] == [2]
    assert [r.v for r in read_snapshot(spark, snapshots, "load", "202303").collect()] == [3]


def test_snapshot_of_an_unknown_period_is_everything(spark, snapshots):
    assert sorted(r.v for r in read_snapshot(spark, snapshots, "load", "209912").collect()) == [1, 2, 3]
    assert sorted(r.v for r in read_snapshot(spark, snapshots, "no_such_column", "202301").collect()) == [1, 2, 3]


def test_snapshot_with_plain_values(spark):
    path = new_path(spark, "test-snapshots")
    overwrite_partitions(spark.createDataFrame([(202301, 1), (202302, 2)], "part int, v int"), path, ["part"])
    assert [r.v for r in read_snapshot(spark, path, "part", "202302").collect()] == [2]


def test_latest_load_of_nothing(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 0.05), (2, 3.0)], "part int, v double")
    assert [r.v for r in latest_load(df, "part", "v", 0.1).collect()] == [3.0]
    assert latest_load(df.limit(0), "part", "v", 0.1).count() == 0


def test_slice_prunes_partitions(spark, snapshots):
    df = read_slice(spark, snapshots, {"load": "20230301-202303"})
    assert "PartitionFilters: [isnotnull(load" in df._jdf.queryExecution().executedPlan().toString()


def test_values_that_do_not_fit_become_null(spark):
    df = spark.createDataFrame([("", "1.005"), ("7", "x")], "a string, b string")
    out = typed_projection(df, [("a", "n", "int"), ("b", "v", "decimal(24,10)")])
    assert [tuple(r) for r in out.collect()] == [(None, Decimal("1.0050000000")), (7, None)]


def test_replace_slice_of_unlisted_scenarios(spark):
    path = new_path(spark, "test-slice")
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "p int, s int, v string")
    overwrite_partitions(df, path, ["p", "s"])
    replace_slice(df.limit(0), path, "p", 1, "s", [2])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == ["a", "c"]
    outside = spark.createDataFrame([(1, 3, "d"), (9, 9, "outside")], "p int, s int, v string")
    for scenarios in (None, [3, 9], [2]):
        with pytest.raises(Exception, match="outside the slice"):
            replace_slice(outside, path, "p", 1, "s", scenarios)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == ["a", "c"]
    replace_slice(outside.where("p = 1"), path, "p", 1, "s", None)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == ["c", "d"]


def test_stage_boundary_keeps_other_partitions(spark):
    path = new_path(spark, "test-stage")
    for period in (1, 2, 2):
        rows = spark.createDataFrame([(period, "x")], "p int, v string")
        assert stage_boundary(rows, path, ["p"], {"p": period}).count() == 1
    assert spark.read.parquet(path).count() == 2


def test_configured_round_trip(spark):
    roots = {"c": shared_dir(spark) + "/ledgerloom"}
    record = configured.parse_records('{"container": "c", "path": "cfg-test", "format": "json"}')[0]
    configured.write_configured(spark.range(3), record, roots)
    assert configured.read_configured(spark, record, roots).count() == 3
    assert configured.parse_records(" ") == []
    configured.apply_settings(spark, {"spark.sql.shuffle.partitions": "7"})
    assert spark.conf.get("spark.sql.shuffle.partitions") == "7"
    configured.apply_settings(spark, {"spark.sql.shuffle.partitions": "8"})


def test_catalogue(spark):
    catalogue = spark.createDataFrame(
        [("w1", [("r1", "d1"), ("r2", "d2")]), ("w2", []), ("w3", None)],
        "workspace string, reports array<struct<name string, dataset_id string>>",
    )
    measures = spark.createDataFrame([("d1", "m1", "x"), ("d1", "m2", "y")], "dataset string, measure string, expression string")
    got = {(r.workspace, r.report, r.measure) for r in catalogue_measures(catalogue, measures).collect()}
    assert got == {("w1", "r1", "m1"), ("w1", "r1", "m2"), ("w1", "r2", None)}


def test_master_load(spark):
    df = spark.createDataFrame([("7", "name", "2024-01-01T10:00")], "id string, n string, t string")
    assert tuple(load_master(df, [("id", "id", "int"), ("n", "label", "string")], "t", "stamp").first()) == (7, "name", "2024-01-01 10:00")


def test_create_and_insert(spark):
    df = literal_table(spark, "id int, name string", [(1, "a"), (2, "b")])
    path = new_path(spark, "test-users")
    name = "users_" + path.rsplit("-", 1)[1]
    assert create_table_from(df, name, path).count() == 2
    assert create_table_from(df.where(F.col("id") == 1), name, path).count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "s.t", True, 4, user="u")
    assert options["truncate"] == "true" and options["batchsize"] == "1000000" and options["numPartitions"] == "4"
    assert options["user"] == "u"


def test_a_failed_replacement_leaves_the_slice_whole(spark):
    path = new_path(spark, "test-slice")
    df = spark.createDataFrame([(1, s, f"{s}") for s in (1, 2, 3)] + [(2, 1, "other")], "p int, s int, v string")
    overwrite_partitions(df, path, ["p", "s"])
    before = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    # Half of the rows can be written; a task of the other half fails.
    new = spark.range(0, 4000, 1, 8).select(
        F.lit(1).alias("p"), (F.col("id") % 2 + 1).cast("int").alias("s"),
        F.when(F.col("id") == 3999, F.raise_error(F.lit("half-way"))).otherwise(F.col("id").cast("string")).alias("v"),
    )
    with pytest.raises(Exception, match="half-way"):
        replace_slice(new, path, "p", 1, "s", [1, 2, 3])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == before
    whole = spark.range(0, 4000, 2, 8).selectExpr("1 as p", "1 as s", "string(id) as v")
    replace_slice(whole, path, "p", 1, "s", [1, 2])
    after = spark.read.parquet(path)
    assert {(r.p, r.s): r["count"] for r in after.groupBy("p", "s").count().collect()} == {(1, 1): 2000, (1, 3): 1, (2, 1): 1}
    leaves = {f.name for f in partition_folders(spark, f"{path}/p=1", "s")}
    assert leaves == {"s=1", "s=3"}


def test_a_slice_may_be_made_of_its_own_rows(spark):
    path = new_path(spark, "test-slice")
    overwrite_partitions(spark.createDataFrame([(1, 1, 5), (1, 2, 6)], "p int, s int, v int"), path, ["p", "s"])
    own = spark.read.parquet(path)
    replace_slice(own.where("s = 1").withColumn("v", F.col("v") + 1), path, "p", 1, "s", [1])
    assert sorted((r.s, r.v) for r in spark.read.parquet(path).collect()) == [(1, 6), (2, 6)]


def test_snapshots_below_plain_folders(spark):
    path = new_path(spark, "test-snapshots")
    for folder, rows in {
        "2022/first": [("20220101-202301", 1)],
        "2023/first": [("20230101-202301", 2), ("20230201-202302", 3)],
        "2023": [("20220901-202301", 4)],
        "_hidden": [("20990101-202301", 9)],
    }.items():
        overwrite_partitions(spark.createDataFrame(rows, "load string, v int"), f"{path}/{folder}", ["load"])
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    folders = partition_folders(spark, path, "load")
    assert len(folders) == 4 and spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before  # no job for the choice
    got = read_snapshot(spark, path, "load", "202301")
    assert [(r.load, r.v) for r in got.collect()] == [("20220901-202301", 4)]  # 2023/load=... is after 2023/first/...
    assert [r.v for r in read_snapshot(spark, path, "load", "202302").collect()] == [3]
    assert sorted(r.v for r in read_snapshot(spark, path, "load", "209901").collect()) == [1, 2, 3, 4]
    assert partition_folders(spark, f"{path}/missing", "load") == []  # cannot be listed


def test_latest_partition_by_folder_names(spark):
    path = new_path(spark, "test-loads")
    overwrite_partitions(spark.createDataFrame([(9, "a"), (10, "b"), (None, "c")], "part int, v string"), path, ["part"])
    assert [r.v for r in read_latest(spark, path, "part").collect()] == ["b"]
    path = new_path(spark, "test-loads")
    overwrite_partitions(spark.createDataFrame([("a b", "a"), ("a c/d", "b")], "part string, v string"), path, ["part"])
    assert [r.v for r in read_latest(spark, path, "part").collect()] == ["b"]
    plan = read_latest(spark, path, "part")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Subquery" not in plan
    path = new_path(spark, "test-loads")
    spark.range(3).write.parquet(path)
    assert read_latest(spark, path, "part").count() == 0


def test_counts_are_observed_in_the_write(spark):
    path = new_path(spark, "test-counts")
    df = spark.range(100)
    counts = reconciled_write(df, lambda d: d.where("id % 4 = 0"), lambda d: d.write.parquet(path))
    assert counts == {"rows_read": 100, "rows_written": 25, "agree": False}
    assert reconciled_write(df, lambda d: d, lambda d: d.write.mode("append").parquet(path))["agree"]
    assert reconciled_write(df.limit(0), lambda d: d, lambda d: d.write.mode("append").parquet(path)) == {"rows_read": 0, "rows_written": 0, "agree": True}
