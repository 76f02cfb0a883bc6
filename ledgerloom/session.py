"""Session settings, the shared working folder and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks. On a cluster use the session the cluster provides."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a machine-local folder
    would be lost together with its executor, so a missing setting is an error there.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = context.getCheckpointDir()
    if base is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="ledgerloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base.rstrip("/")


_scopes: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path below the shared folder; each call gives another one."""
    path = f"{shared_dir(spark)}/ledgerloom/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the stages made inside once it ends well; after a failure they stay, to be looked at.

    What is used after the scope must not start from one of them.
    """
    _scopes.append([])
    try:
        yield
    except BaseException:
        _scopes.pop()
        raise
    for path in _scopes.pop():
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stage_rows(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back; later readers prune its columns."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that a lost executor cannot change what is read later."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
