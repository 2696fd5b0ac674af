"""Idempotent appends, full refreshes and exports."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverlens import schemas as S
from coverlens.operators.dedup import distinct_on
from coverlens.sources import files, keyindex
from coverlens.sources.landing import read_table

BATCH = "batch"  # partition column of staging tables: one folder per run or micro-batch


def batched(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])


def rejects(spark: SparkSession, path: str, schema: T.StructType, batch: str | None = None) -> DataFrame:
    """The rows that appends to ``path`` (or one batch of them) did not take, with the ``reason``."""
    wide = T.StructType([*schema.fields, T.StructField("reason", T.StringType())])
    if batch is None:
        return read_table(spark, f"{path}-rejects", batched(wide))
    return read_table(spark, f"{path}-rejects/{BATCH}={batch}", wide)


def append_new(spark: SparkSession, rows: DataFrame, path: str, schema: T.StructType, key: str,
               batch: str, order: Sequence[Column] = (), rejected: DataFrame | None = None) -> DataFrame:
    """Append the rows whose key is not stored; return what this batch holds.

    Rows without a key are strangers to each other and cannot be compared: they go to the
    table's rejects with a reason, and so do the rows of ``rejected`` (which has a reason).

    Each batch owns one folder and overwrites it, and its own folder is left out
    of the comparison.  So a batch that is run again on the same input, also after
    a half-done write, ends with the same rows.  Duplicates inside the batch keep the first
    by ``order``, then by a hash of the row, so that a recomputed task picks the
    same one.

    What is stored is looked up in the table's key index, in the buckets that the batch
    touches (``keyindex``), so an append costs what the batch holds.
    """
    if not re.fullmatch(r"[A-Za-z][\w\-]*", batch):
        raise ValueError("a batch name starts with a letter")
    keyindex.finish_compaction(spark, path, schema, key)
    keyindex.repair(spark, path, schema, key, without=batch)
    conformed = S.conform(rows, schema)
    refused = conformed.filter(F.col(key).isNull()).withColumn("reason", F.lit(f"no {key}"))
    if rejected is not None:
        refused = refused.unionByName(rejected.select(*schema.names, "reason"))
    refused.write.mode("overwrite").parquet(f"{path}-rejects/{BATCH}={batch}")
    candidates = distinct_on(conformed.filter(F.col(key).isNotNull()), [key], [*order, F.xxhash64(*schema.names)])
    folder = f"{path}/{BATCH}={batch}"
    stored = keyindex.lookup(spark, path, schema, key, conformed, without=batch)
    # without an index until its rows are there: a run that stops in between is noticed by the next
    keyindex.forget_batch(spark, path, batch)
    candidates.join(stored, key, "left_anti").write.mode("overwrite").parquet(folder)
    keyindex.index_batch(spark, path, schema, key, batch)
    return read_table(spark, folder, schema)


def insert_delta(fetched: DataFrame, inserted: DataFrame, rejected: DataFrame) -> DataFrame:
    """fetched, inserted, rejected and skipped counts; ``fetched`` holds all the others.

    Counted from tables, not from accumulators, which may count a task twice when
    an executor is lost."""
    kinds = {"n_fetched": fetched, "n_inserted": inserted, "n_rejected": rejected}
    counts = [frame.agg(*[(F.count("*") if name == kind else F.lit(0).cast("bigint")).alias(name) for name in kinds])
              for kind, frame in kinds.items()]
    total = reduce(DataFrame.unionByName, counts).agg(*[F.sum(name).alias(name) for name in kinds])
    return total.withColumn("n_skipped", F.col("n_fetched") - F.col("n_inserted") - F.col("n_rejected"))


def full_refresh(df: DataFrame, path: str, version: str) -> DataFrame:
    """Write a whole table as a new version; readers switch when it is complete.

    Every attempt has a folder of its own and the pointer row comes last, so a failed
    write, also one that repeats a version, leaves the table as it was."""
    spark = df.sparkSession
    attempt = f"{version}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(f"{path}/data/{attempt}")
    entry = spark.range(1).select(F.lit(version).alias("version"), F.lit(attempt).alias("attempt"),
                                  F.localtimestamp().alias("written_at"))
    entry.write.mode("append").parquet(f"{path}/versions")
    return current(spark, path)


def current(spark: SparkSession, path: str) -> DataFrame:
    """The latest complete version of a refreshed table."""
    last = (spark.read.parquet(f"{path}/versions")
            .agg(F.max_by("attempt", F.struct("written_at", "version", "attempt")).alias("attempt")).first())
    return spark.read.parquet(f"{path}/data/{last['attempt']}")


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all but the latest ``keep`` complete versions of a refreshed table and what failed attempts left; how many folders went.

    Not to run while a refresh is being written."""
    if keep < 1:
        raise ValueError("keep at least the current version")
    rows = spark.read.parquet(f"{path}/versions").orderBy(F.desc("written_at"), F.desc("version"), F.desc("attempt")).limit(keep)
    kept = {r["attempt"] for r in rows.collect()}
    gone = [name for name in files.folders(spark, f"{path}/data") if name not in kept]
    for name in gone:
        files.remove(spark, f"{path}/data/{name}")
    return len(gone)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, compression: str = "none", rows_per_file: int = 250_000) -> None:
    """CSV with a header, quotes doubled, text kept as it is (edge blanks, line breaks).

    Multi-line CSV cannot be split: a file is read by one task, so choose ``rows_per_file``
    (all rows are written, to as many files as it takes) by the rows' size."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("maxRecordsPerFile", rows_per_file)
     .option("compression", compression).option("zlib.compress.level", "BEST_COMPRESSION").csv(path))


def write_csv_gzip(df: DataFrame, path: str) -> None:
    write_csv(df, path, "gzip")


def read_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """An exported CSV (plain or gzip) as all-string records; missing values are ''."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("escape", '"').option("enforceSchema", False).csv(path).na.fill(""))


def write_nested(df: DataFrame, path: str, properties: Sequence[str]) -> None:
    """Rows laid out in folders by nested properties.

    Not repartitioned by the properties: a hot group stays spread over tasks."""
    df.write.mode("overwrite").partitionBy(*properties).parquet(path)


EXPORTS = ("parquet", "csv", "csv_gzip")


def export(df: DataFrame, path: str) -> None:
    """Parquet, CSV and gzip CSV of one frame.  The plan runs once, for Parquet;
    the other two read that table."""
    write_parquet(df, f"{path}/parquet")
    table = df.sparkSession.read.parquet(f"{path}/parquet")
    write_csv(table, f"{path}/csv")
    write_csv_gzip(table, f"{path}/csv_gzip")


def export_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(export, n_rows, n_files, n_bytes, pct_saved): sizes next to the plain CSV.

    Rows come from the Parquet footers; the file listing reads no contents."""
    n_rows = spark.read.parquet(f"{path}/parquet").count()
    files = None
    for name in EXPORTS:
        found = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
                 .load(f"{path}/{name}").select(F.lit(name).alias("export"), "length"))
        files = found if files is None else files.unionByName(found)
    sizes = files.groupBy("export").agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))
    csv_bytes = sizes.filter(F.col("export") == "csv").first()["n_bytes"]
    return sizes.select("export", F.lit(n_rows).cast("bigint").alias("n_rows"), "n_files", "n_bytes",
                        F.round((1 - F.col("n_bytes") / F.lit(float(csv_bytes))) * 100, 1).alias("pct_saved"))
