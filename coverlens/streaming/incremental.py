"""Incremental landing as Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverlens.operators.dedup import distinct_on
from coverlens.operators.lookup import only_new
from coverlens.sources import writers
from coverlens.sources.landing import read_table


def stream_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                 files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_append(stream: DataFrame, target: str, checkpoint: str, schema: T.StructType, key: str,
                  order: Sequence[Column] = ()):
    """Land what is new, then stop: append by key with no time horizon.

    The target's key column is the state.  A micro-batch that is replayed after a
    failure overwrites its own folder, so rows are stored once.  Folders carry the
    query's id, which lives in the checkpoint: a stream that starts over with a new
    checkpoint cannot overwrite what an earlier one landed.
    """
    def land(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        writers.append_new(spark, rows, target, schema, key, f"stream-{query_id}-{batch_id:012d}", order)

    return (stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def bounded_dedup(stream: DataFrame, key: str, event_time: str, horizon: str) -> DataFrame:
    """Dedup with bounded state: keys are forgotten once the watermark passes them by
    ``horizon``, and rows later than that are dropped by the stream: ``append_late`` stores
    them.  An option for unending streams; ``stream_append`` has no such horizon."""
    return stream.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark([key])


def append_late(spark: SparkSession, delivered: DataFrame, target: str, key: str) -> None:
    """Store the delivered rows that a bounded stream dropped as too late, one per key (by a hash of the row).

    They are found by an anti join on the stored keys and kept beside the stream's own
    files, whose log must not change; ``read_all`` reads both."""
    one = distinct_on(delivered, [key], [F.xxhash64(*delivered.columns)])
    late = only_new(one, read_all(spark, target, delivered.schema), key)
    late.write.mode("append").parquet(f"{target}-late")


def read_all(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """What the stream stored and what ``append_late`` added."""
    return spark.read.schema(schema).parquet(target).unionByName(read_table(spark, f"{target}-late", schema))


def stream_table(stream: DataFrame, target: str, checkpoint: str):
    """Write an append-mode stream to Parquet until the available input is used up."""
    return (stream.writeStream.format("parquet").option("path", target)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start())
