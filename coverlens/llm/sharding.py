"""Extendible hashing: documents dealt into shards by hash prefix, only oversized buckets split.

A shard is a prefix of the key's 60 hash bits.  The directory starts with the empty
prefix; a bucket above the byte limit splits on its next bit, any other stays whole.
Everything is a DataFrame plan: sizes are summed per prefix before they are
compared, so no bucket's documents meet in one task.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlens.llm.common import written

HASH_BITS = 60
SHARD_BYTES = 32 * 1024 * 1024
STEP_BITS = 6  # prefix bits looked at per pass beyond the expected depth


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the key's md5, as a long."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(bits: Column, depth: Column | int) -> Column:
    """The leading ``depth`` bits."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", bits, F.lit(HASH_BITS) - depth)


def _closed(cells: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """Buckets of depth low..high that end the splitting: they fit, or hold one hash only, and their parent does not."""
    parts = cells.select(
        F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"), "cell", "bytes", "first", "last").select(
        "depth", F.call_function("shiftright", "cell", F.lit(high) - F.col("depth")).alias("prefix"),
        "bytes", "first", "last")
    buckets = parts.groupBy("depth", "prefix").agg(
        F.sum("bytes").alias("shard_bytes"), (F.min("first") == F.max("last")).alias("single"))
    ends = (F.col("shard_bytes") <= limit) | F.col("single")
    open_children = (buckets.filter(~ends)
                     .select((F.col("depth") + 1).alias("depth"),
                             F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix")))
    top = buckets.filter(ends & (F.col("depth") == low))
    return buckets.filter(ends).join(open_children, ["depth", "prefix"], "left_semi").unionByName(top)


def assign_shards(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """One row per input row: ``key``, shard (its prefix as a bit string), depth, n_bytes, shard_bytes, fits.

    The hash is taken of the key; a null key is hashed by its text, so rows without a
    key spread too.  A null text has 0 bytes.  Rows of equal hash (a repeated key) stay
    together: a bucket that holds one hash only is never split, and ``fits`` is false if
    it exceeds the limit, as it is for a single larger document.  An empty table has no
    rows.  Other columns of ``docs`` play no part.
    """
    if limit < 1:
        raise ValueError("the byte limit must be positive")
    source = F.coalesce(F.col(key).cast("string"), F.col(text), F.lit(""))
    rows = written(docs.select(
        F.col(key).alias("key"), hash_bits(source).alias("bits"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes")), "shard-rows")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    # the expected depth only decides how many levels one pass looks at
    low, high = 0, min(HASH_BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + STEP_BITS)
    rest, found = rows, []
    while True:
        cells = written(rest.groupBy(_prefix(F.col("bits"), high).alias("cell")).agg(
            F.sum("n_bytes").alias("bytes"), F.min("bits").alias("first"), F.max("bits").alias("last")), "shard-cells")
        closed = written(_closed(cells, low, high, limit), "shard-buckets")
        # every fine cell lies in at most one closed bucket
        of_cell = (cells.select("cell", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
                   .withColumn("prefix", F.call_function("shiftright", "cell", F.lit(high) - F.col("depth")))
                   .join(closed, ["depth", "prefix"]).select("cell", "depth", "prefix", "shard_bytes"))
        rest = rest.withColumn("cell", _prefix(F.col("bits"), high))
        found.append(rest.join(of_cell, "cell"))
        if high == HASH_BITS:
            break
        open_cells = cells.join(of_cell, "cell", "left_anti")
        if open_cells.isEmpty():
            break
        rest = written(rest.join(open_cells, "cell", "left_semi").drop("cell"), "shard-rest")
        low, high = high + 1, min(HASH_BITS, high + STEP_BITS)
    placed = reduce(DataFrame.unionByName, found)
    return placed.select(
        F.col("key").alias(key),
        F.when(F.col("depth") == 0, "").otherwise(F.expr("lpad(bin(prefix), depth, '0')")).alias("shard"),
        F.col("depth").cast("int").alias("depth"), "n_bytes", "shard_bytes",
        (F.col("shard_bytes") <= limit).alias("fits"))


def write_shards(docs: DataFrame, shards: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write the documents as one folder per shard; ``shards`` comes from ``assign_shards`` and has unique keys."""
    (docs.join(shards.select(key, "shard"), key).repartition("shard")
     .write.partitionBy("shard").parquet(path))


def oracle_sql(limit: int = SHARD_BYTES) -> str:
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 15))::BIGINT AS h
  FROM documents),
level AS (SELECT unnest(range(0, {HASH_BITS + 1})) AS depth),
bucket AS (
  SELECT depth, h >> ({HASH_BITS} - depth) AS prefix, sum(n_bytes) AS shard_bytes,
         sum(n_bytes) <= {limit} OR min(h) = max(h) AS ends
  FROM d, level GROUP BY ALL),
leaf AS (
  SELECT h, min(depth) AS depth
  FROM d JOIN level ON true JOIN bucket USING (depth)
  WHERE prefix = h >> ({HASH_BITS} - depth) AND ends GROUP BY h)
SELECT doc_id, CASE WHEN leaf.depth = 0 THEN '' ELSE lpad(bin(prefix), leaf.depth::INT, '0') END AS shard,
       leaf.depth::INT AS depth, n_bytes::BIGINT AS n_bytes, shard_bytes::BIGINT AS shard_bytes, shard_bytes <= {limit} AS fits
FROM d JOIN leaf USING (h)
JOIN bucket ON bucket.depth = leaf.depth AND prefix = h >> ({HASH_BITS} - leaf.depth)"""
