"""Facet counts kept between runs: how many rows have each combination of attributes, change by change.

Counts of combinations add up, so a change is a small table of its own: rows that came count one, rows that went
minus one.  Reading sums all changes.  ``facets.crossfilter`` then works on the combinations with ``weight``.
A change owns one folder and overwrites it: one that is made again counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverlens.sources import files

CHANGE, COUNT = "change", "n"


def latest(spark: SparkSession, path: str) -> str | None:
    """Name of the last change (by name) that was written out."""
    names = [f for f in files.complete(spark, path) if f.startswith(f"{CHANGE}=")]
    return names[-1].removeprefix(f"{CHANGE}=") if names else None


def _counted(rows: DataFrame, sign: int) -> DataFrame:
    return rows.groupBy(*rows.columns).agg((F.count("*") * sign).alias(COUNT))


def add(added: DataFrame, removed: DataFrame | None, path: str, change: str) -> None:
    """Take in a change: rows of attributes (all columns) that came and that went.  Names of changes increase."""
    counts = _counted(added, 1)
    if removed is not None:
        counts = counts.unionByName(_counted(removed, -1))
    counts = counts.groupBy(*added.columns).agg(F.sum(COUNT).alias(COUNT)).filter(F.col(COUNT) != 0)
    counts.write.mode("overwrite").parquet(f"{path}/{CHANGE}={change}")


def _schema(attributes: T.StructType) -> T.StructType:
    return T.StructType([*attributes.fields, T.StructField(COUNT, T.LongType())])


def read(spark: SparkSession, path: str, attributes: T.StructType) -> DataFrame:
    """Attributes and ``n``: the combinations that rows have now.  A change that was not written out does not count."""
    names = [f for f in files.complete(spark, path) if f.startswith(f"{CHANGE}=")]
    if not names:
        return spark.createDataFrame([], _schema(attributes))
    stored = spark.read.schema(_schema(attributes)).parquet(*[f"{path}/{name}" for name in names])
    return stored.groupBy(*attributes.names).agg(F.sum(COUNT).alias(COUNT)).filter(F.col(COUNT) != 0)


def compact(spark: SparkSession, path: str, attributes: T.StructType) -> None:
    """All changes in the folder of the last one; a reader meanwhile sees the old folders or none.

    The sums are complete beside the table before the first folder goes; ``finish`` ends what a stopped call left.
    """
    finish(spark, path)
    last = latest(spark, path)
    if last is not None:
        read(spark, path, attributes).write.mode("overwrite").parquet(f"{path}/_sum-{last}")
        finish(spark, path)


def finish(spark: SparkSession, path: str) -> None:
    for name in files.folders(spark, path):
        if not name.startswith("_sum-"):
            continue
        if not files.exists(spark, f"{path}/{name}/_SUCCESS"):
            files.remove(spark, f"{path}/{name}")
            continue
        last = f"{CHANGE}={name.removeprefix('_sum-')}"
        for old in files.folders(spark, path):
            if old.startswith(f"{CHANGE}=") and old <= last:
                files.remove(spark, f"{path}/{old}")
        files.move(spark, f"{path}/{name}", f"{path}/{last}")


def reset(spark: SparkSession, path: str) -> None:
    """Forget all changes."""
    files.remove(spark, path)
