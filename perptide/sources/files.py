"""Deleting what a table no longer lists, in whatever store Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; none where it does not exist."""
    system, where = _path(spark, path)
    if not system.exists(where):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(where) if s.isDirectory())


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a folder that no list names any more; False where it is gone already."""
    system, where = _path(spark, path)
    return system.delete(where, True)
