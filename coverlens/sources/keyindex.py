"""The keys of an append-only table, in hash buckets: a batch looks up its keys in the buckets it touches.

The index of table ``path`` lies beside it in a folder named after the number of buckets, one folder per batch like the table's own and in it one per bucket.
Files hold nothing but keys, sorted, with a Bloom filter per row group, so that a lookup of a few keys skips
row groups.  A batch is indexed after its rows are written; what a stopped run left
unindexed is found by comparing folder names and is indexed before the next lookup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverlens.sources import files
from coverlens.sources.landing import read_table

BATCH, BUCKET = "batch", "key_bucket"
BUCKETS = 64
FEW = 10  # so many keys are looked up by value, through the Bloom filters


def index_path(path: str, buckets: int = BUCKETS) -> str:
    return f"{path}-keys{buckets}"


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def index_schema(schema: T.StructType, key: str) -> T.StructType:
    return T.StructType([schema[key], T.StructField(BATCH, T.StringType()), T.StructField(BUCKET, T.IntegerType())])


def index_batch(spark: SparkSession, path: str, schema: T.StructType, key: str, batch: str, buckets: int = BUCKETS) -> None:
    """(Re)write the index of one batch from the rows stored for it."""
    keys = read_table(spark, f"{path}/{BATCH}={batch}", schema).select(key).filter(F.col(key).isNotNull())
    # buckets of a large batch are split by Spark as it sees fit, small ones share tasks
    spread = keys.withColumn(BUCKET, bucket_of(F.col(key), buckets)).hint("rebalance", BUCKET)
    (spread.sortWithinPartitions(BUCKET, key).write.mode("overwrite").partitionBy(BUCKET)
     .option(f"parquet.bloom.filter.enabled#{key}", "true")
     .parquet(f"{index_path(path, buckets)}/{BATCH}={batch}"))


def forget_batch(spark: SparkSession, path: str, batch: str, buckets: int = BUCKETS) -> None:
    """Drop a batch's index: from now on it counts as not indexed."""
    files.remove(spark, f"{index_path(path, buckets)}/{BATCH}={batch}")


def repair(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS, without: str | None = None) -> list[str]:
    """Index the stored batches that are not (those of a stopped run, or of a table older than its index); their names."""
    indexed = set(files.complete(spark, index_path(path, buckets)))
    names = [f.removeprefix(f"{BATCH}=") for f in files.folders(spark, path) if f.startswith(f"{BATCH}=") and f not in indexed]
    found = [name for name in names if name != without]
    for name in found:
        index_batch(spark, path, schema, key, name, buckets)
    return found


def lookup(spark: SparkSession, path: str, schema: T.StructType, key: str, wanted: DataFrame, without: str | None = None,
           buckets: int = BUCKETS) -> DataFrame:
    """The keys of ``wanted`` that the table holds, each once; batch ``without`` is left out.

    Only files of the buckets that ``wanted`` touches are opened; their numbers, at most ``buckets``, come to the driver.
    """
    wanted = wanted.select(key).filter(F.col(key).isNotNull())
    seen = wanted.agg(F.collect_set(bucket_of(F.col(key), buckets)).alias("touched"), F.count("*").alias("n")).first()
    stored = read_table(spark, index_path(path, buckets), index_schema(schema, key)).filter(F.col(BUCKET).isin(sorted(seen["touched"])))
    if without is not None:
        stored = stored.filter(F.col(BATCH) != without)
    stored = stored.select(key)
    if 0 < seen["n"] <= FEW:
        stored = stored.filter(F.col(key).isin([r[0] for r in wanted.collect()]))
    return stored.join(wanted.distinct(), key, "left_semi").distinct()


def compact(spark: SparkSession, path: str, schema: T.StructType, key: str, through: str, buckets: int = BUCKETS) -> int:
    """Merge the batches up to and including ``through`` (by name) into one of that name; how many there were.

    Batches that are merged can no longer be run again, so ``through`` should lie before the latest.  Not to run beside
    readers or writers of the table.  The merged rows are complete before an old folder goes, and ``finish_compaction``,
    which every append calls, ends what a stopped compaction left.
    """
    finish_compaction(spark, path, schema, key, buckets)
    names = [f.removeprefix(f"{BATCH}=") for f in files.folders(spark, path) if f.startswith(f"{BATCH}=")]
    names = [name for name in names if name <= through]
    if through not in names or len(names) < 2:
        return len(names)
    wide = T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])
    merged = read_table(spark, path, wide).filter(F.col(BATCH) <= through).drop(BATCH)
    # a hidden folder, so readers of the table do not see it; its name holds the plan
    merged.write.mode("overwrite").parquet(f"{path}/_merged-{through}")
    finish_compaction(spark, path, schema, key, buckets)
    return len(names)


def finish_compaction(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS) -> None:
    """Put merged rows in the place of the batches they came from; a merge that was not written out is dropped."""
    for name in files.folders(spark, path):
        if not name.startswith("_merged-"):
            continue
        through = name.removeprefix("_merged-")
        if files.exists(spark, f"{path}/{name}/_SUCCESS"):
            for old in files.folders(spark, path):
                if old.startswith(f"{BATCH}=") and old.removeprefix(f"{BATCH}=") <= through:
                    forget_batch(spark, path, old.removeprefix(f"{BATCH}="), buckets)
                    files.remove(spark, f"{path}/{old}")
            files.move(spark, f"{path}/{name}", f"{path}/{BATCH}={through}")
            index_batch(spark, path, schema, key, through, buckets)
        else:
            files.remove(spark, f"{path}/{name}")
