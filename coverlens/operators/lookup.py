"""Lookup joins and work-list (anti) joins.

No broadcast hints here: Spark broadcasts a side when its own size estimate or
AQE's measured size is under ``spark.sql.autoBroadcastJoinThreshold``; beyond that
the plan is a sort-merge join whose skewed partitions AQE splits.  Only the literal
dimensions of ``sources.dims``, whose size is fixed, carry a hint.  ``salts`` gives a
further, explicit way for a lookup side too large to broadcast with a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_left(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                salts: int = 1, spread: Column | None = None) -> DataFrame:
    """Left join of a fact to a dimension that is unique on ``dim_key``.

    With ``salts > 1`` the rows of each key are spread over that many reduce
    tasks by a hash of ``spread`` (any column that varies within a key) and the
    dimension is replicated as often.  The result is the same rows.
    """
    if salts <= 1:
        return fact.join(dim, fact[fact_key] == dim[dim_key], "left").drop(dim[dim_key])
    if spread is None:
        raise ValueError("salts needs a spread column")
    salted_fact = fact.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    salted_dim = dim.withColumn("_dim_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (salted_fact
            .join(salted_dim, (salted_fact[fact_key] == salted_dim[dim_key])
                  & (F.col("_salt") == F.col("_dim_salt")), "left")
            .drop(salted_dim[dim_key]).drop("_salt", "_dim_salt"))


def lookup_default(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                   defaults: Mapping[str, object], salts: int = 1,
                   spread: Column | None = None) -> DataFrame:
    """``lookup_left`` with the default member where nothing matched."""
    joined = lookup_left(fact, dim, fact_key, dim_key, salts, spread)
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def resolve_names(df: DataFrame, lookups: Mapping[str, tuple[DataFrame, str]],
                  how: str = "inner") -> DataFrame:
    """Replace names by ids: ``{name_column: (dimension with id and name, id_column)}``."""
    for column, (dim, id_column) in lookups.items():
        side = dim.select(F.col("name").alias(column), F.col("id").alias(id_column))
        df = df.join(side, column, how)
    return df


def pending(todo: DataFrame, done: DataFrame, todo_key: str, done_key: str) -> DataFrame:
    """Rows of ``todo`` whose key is not in ``done``.

    ``left_anti``, not ``NOT IN``: a NULL in ``done`` does not empty the result
    and the join can shuffle.  The done side is reduced to distinct keys first,
    map-side, so a key that repeats there costs nothing.
    """
    keys = done.select(F.col(done_key).alias(todo_key)).distinct()
    return todo.join(keys, todo_key, "left_anti")


def only_new(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of a batch whose key is not stored yet.

    The history is first reduced to the keys that the batch also has.  That side
    of the semi join is the batch, so a small batch is broadcast to the scan and
    the history is read once, key column only, without being shuffled.
    """
    batch_keys = batch.select(key).distinct()
    stored = target.select(key).join(batch_keys, key, "left_semi").distinct()
    return batch.join(stored, key, "left_anti")


def orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Foreign-key values without a dimension row, with the number of fact rows.

    Counting per value comes first, so the join sees each value once."""
    counts = fact.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("n_rows"))
    return counts.join(dim.select(F.col(pk).alias(fk)).distinct(), fk, "left_anti")
