"""A training corpus in five stages: quality, near-duplicates, repeated strings, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the next one's ``docs``.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.llm import bpe, mixing, near_dedup, quality, suffix_dedup
from coverlens.llm.common import read_table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of those not held out, predicts to be good.

    The texts are read twice, for the statistics of the labelled ones and for the filter, but never shuffled.
    """
    labels = quality.training_labels(read_table(spark, sf_dir, "labels"), "doc_id", 3, 1)
    model = quality.fit(quality.statistics_table(docs, "doc_id", "text"), labels, "doc_id", "quality")
    return docs.filter(quality.score_column(model, F.col("text")) >= 0.5)


NEAR, NEAR_BAND_ROWS = 80, 7  # per cent; 36 bands miss a pair at exactly that similarity with probability 0.0002


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows with ``_key``: their id, or one made from the text, from 2^61 up, which equal texts without an id share."""
    made = F.lit(1 << 61) + F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(1 << 61))
    return docs.withColumn("_key", F.coalesce(F.col("doc_id").cast("long"), made))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id, and once only.

    Rows without an id are documents too; they stay only where no alike document has an id, of equal texts one.
    Documents without words are in no group and all stay.
    """
    keyed = _keyed(docs)
    found = near_dedup.near_duplicates(keyed.select("_key", "text"), key="_key", similar=NEAR, band_rows=NEAR_BAND_ROWS)
    kept = found.filter("kept").groupBy("_key").agg((F.max("n_shingles") > 0).alias("_has_words"))
    there = keyed.join(kept, "_key")
    # a repeated row of a kept document is a copy as well
    worded = there.filter("_has_words").dropDuplicates(["_key"])
    return worded.unionByName(there.filter("NOT _has_words")).select(*docs.columns)


PASSAGE_WORDS = 51  # passages of over 50 words that repeat


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without their passages of over 50 words that also stand elsewhere; n_chars follows the text."""
    shorter = suffix_dedup.without_repeats(docs, unit=suffix_dedup.Unit(PASSAGE_WORDS, words=True))
    if "n_chars" not in docs.columns:
        return shorter
    return shorter.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it, those without an id like others; those it does not take go."""
    keyed = _keyed(docs)
    mixed = mixing.mix(keyed.drop("doc_id"), key="_key")
    times = (mixed.filter("size > 0").groupBy("_key").agg(F.max(F.col("taken") / F.col("size")).cast("int").alias("_times"))
             .filter("_times > 0"))
    repeated = keyed.join(times, "_key")
    return repeated.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*docs.columns)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document: doc_id, n_tokens, ids_sha256, decoded_sha256, ids (32-bit little-endian)."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", drop_repeated_strings),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode_bytes),
]

ORACLE_SQL = None  # training, signatures and merges have no SQL form; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
    return docs
