"""Names and removal of folders, in whatever file system Spark's paths are in."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(spark._jsc.hadoopConfiguration()), located


def exists(spark: SparkSession, path: str) -> bool:
    system, located = _located(spark, path)
    return system.exists(located)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder in order; none if there is no such folder."""
    system, located = _located(spark, path)
    if not system.exists(located):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(located))


def make(spark: SparkSession, path: str) -> None:
    system, located = _located(spark, path)
    system.mkdirs(located)


def remove(spark: SparkSession, path: str) -> None:
    system, located = _located(spark, path)
    system.delete(located, True)
