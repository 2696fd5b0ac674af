"""Data-quality jobs: the constraints that files do not enforce."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens.operators.lookup import orphans, resolve_names
from coverlens.sources.dims import bias_ratings, media_types, states


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_null, n_rows) for all columns in one pass."""
    counted = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null"),
                               F.col("_rows").alias("n_rows")) for c in columns])
    return counted.select(F.explode(cells).alias("c")).select("c.*")


def foreign_keys(checks: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(name, n_values, n_rows) of orphans for every (name, fact, fk, dim, pk)."""
    def one(name, fact, fk, dim, pk):
        return orphans(fact, dim, fk, pk).agg(
            F.lit(name).alias("check_name"), F.count("*").alias("n_values"),
            F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
    return reduce(DataFrame.unionByName, [one(*c) for c in checks])


def lost_in_lookup(staged_outlets: DataFrame) -> DataFrame:
    """Staged outlets that the natural-key joins drop, with the names that have no member."""
    spark = staged_outlets.sparkSession
    ids = {"media_outlet_type": "type_id", "state": "state_id", "bias": "bias_id"}
    dims = {"media_outlet_type": media_types(spark), "state": states(spark), "bias": bias_ratings(spark)}
    joined = resolve_names(staged_outlets, {c: (dims[c], ids[c]) for c in ids}, how="left")
    reasons = F.array_compact(F.array(*[F.when(F.col(i).isNull(), F.lit(c)) for c, i in ids.items()]))
    return (joined.withColumn("reason", F.array_join(reasons, ", "))
            .filter(F.col("reason") != "")
            .select("name", "domain_name", *ids, "reason"))


def unmatched_domains(stories: DataFrame, outlets: DataFrame, domain: str = "media_url") -> DataFrame:
    """Feed domains without an outlet, with their story counts: work for the curator.

    A missing domain counts as one more unmatched value."""
    counts = stories.groupBy(F.col(domain).alias("domain_name")).agg(F.count("*").alias("n_stories"))
    return counts.join(outlets.select("domain_name"), "domain_name", "left_anti")
