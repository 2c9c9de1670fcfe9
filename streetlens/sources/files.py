"""Looking at folders through the file system of the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path, system = _path(spark, path)
    return system.exists(jvm_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; none if it does not exist. Meant for folders with few entries."""
    jvm_path, system = _path(spark, path)
    if not system.exists(jvm_path):
        return []
    return [status.getPath().getName() for status in system.listStatus(jvm_path)]


def touch(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``, with the folders above it."""
    jvm_path, system = _path(spark, path)
    system.create(jvm_path, True).close()


def remove(spark: SparkSession, path: str) -> None:
    """Take away a file or folder of marks, if it exists."""
    jvm_path, system = _path(spark, path)
    if system.exists(jvm_path):
        system.delete(jvm_path, True)
