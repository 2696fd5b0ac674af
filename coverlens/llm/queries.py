"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from coverlens.llm import (ann, automata, bpe, fingerprint, merkle, mixing, near_dedup, quality, sharding, spelling, suffix_dedup,
                           toxicity, url_filter)
from coverlens.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


@query("op1_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op3_mix_sources", mixing.oracle_sql())
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


@query("op4_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


@query("op5_extendible_sharding", sharding.oracle_sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, sf_dir, "documents"))


@query("op6_cross_polytope")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(read_table(spark, sf_dir, "embeddings"))


@query("op7_url_filter")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.fit(url_filter.labelled_urls(spark))
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), model)


@query("op8_suffix_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_strings(read_table(spark, sf_dir, "documents"))


@query("op9_byte_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read_table(spark, sf_dir, "documents"),
                                public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op10_scaled_fingerprints", fingerprint.oracle_sql())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(read_table(spark, sf_dir, "documents"))


@query("op11_spelling_variants", spelling.oracle_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.vocabulary(read_table(spark, sf_dir, "documents")))


@query("op12_merkle_manifest", merkle.oracle_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered_manifest(read_table(spark, sf_dir, "documents"))


@query("op13_substring_dedup", automata.oracle_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return automata.repeated_passages(read_table(spark, sf_dir, "documents")).drop("spans")


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
