"""Folders of a table by the file system's listing: nothing is opened or scanned."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_log = logging.getLogger(__name__)
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Folder:
    """A partition folder ``column=value`` and the folder it lies in."""

    parent: str
    name: str

    @property
    def path(self) -> str:
        return f"{self.parent}/{self.name}"

    @property
    def value(self) -> str:
        return unquote(self.name.split("=", 1)[1])


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; a folder that cannot be listed has none, and is reported."""
    try:
        system, where = _file_system(spark, path)
        return sorted(s.getPath().getName() for s in system.listStatus(where) if s.isDirectory())
    except Py4JJavaError as error:
        _log.warning("cannot list %s: %s", path, error.java_exception.toString())
        return []


def partition_folders(spark: SparkSession, path: str, column: str) -> list[Folder]:
    """The folders of a partition column in ``path`` and below its plain folders."""
    path, found = path.rstrip("/"), []
    for name in subfolders(spark, path):
        if name.startswith(f"{column}="):
            found.append(Folder(path, name))
        elif not name.startswith(("_", ".")):
            found += partition_folders(spark, f"{path}/{name}", column)
    return found


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds; one that is not there is fine."""
    system, where = _file_system(spark, path)
    system.delete(where, True)


def make_folder(spark: SparkSession, path: str) -> None:
    system, where = _file_system(spark, path)
    system.mkdirs(where)


def move_folder(spark: SparkSession, source: str, target: str) -> bool:
    """Move a folder to a name that is free; False, and nothing changed, if another has taken it.

    The file system decides in one step on stores that rename atomically.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    never_over = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    never_over[0] = hadoop.Options.Rename.NONE
    where = hadoop.Path(target)
    context = hadoop.FileContext.getFileContext(where.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(hadoop.Path(source), where, never_over)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or "not empty" in str(error.java_exception):
            return False
        raise
    return True
