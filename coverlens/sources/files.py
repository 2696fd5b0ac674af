"""Folders of the shared file system, whatever it is: listed, moved and removed through Hadoop's interface."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _at(spark, path)
    return files.exists(where)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``, sorted; none if there is no such path."""
    files, where = _at(spark, path)
    if not files.exists(where):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(where) if entry.isDirectory())


def complete(spark: SparkSession, path: str) -> list[str]:
    """The folders below ``path`` that a Spark write has finished."""
    return [name for name in folders(spark, path) if exists(spark, f"{path}/{name}/_SUCCESS")]


def remove(spark: SparkSession, path: str) -> None:
    files, where = _at(spark, path)
    files.delete(where, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    files, where = _at(spark, path)
    if not files.rename(where, _at(spark, to)[1]):
        raise OSError(f"could not move {path} to {to}")
