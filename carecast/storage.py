"""Steps on whole files and folders of a table, on whatever file system its path names.

Spark writes and reads tables; dropping a folder, dropping one day of a
partitioned table and moving a finished file into place are Hadoop file system
calls, made from the driver.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The file system of a path, and the path in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all in it; nothing if it isn't there."""
    fs, where = _at(spark, path)
    fs.delete(where, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it isn't there."""
    fs, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file, in one step on file systems whose rename is one."""
    fs, where = _at(spark, path)
    if not fs.rename(where, _at(spark, target)[1]):
        raise OSError(f"could not move {path} to {target}")


def drop_partitions(spark: SparkSession, path: str, column: str, values: Iterable[object]) -> None:
    """Remove the folders of these values of a table partitioned by ``column``."""
    for v in values:
        delete(spark, f"{path.rstrip('/')}/{column}={v}")
