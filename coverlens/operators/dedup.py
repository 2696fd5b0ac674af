"""One row per key, without moving every copy of a hot key to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_on(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row per key under ``order`` (which should be total).

    ``row_number() = 1`` is planned with a window group limit *before* the
    exchange, so each map task sends at most one row per key: a key that holds a
    third of the table costs the reducer one row per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def distinct_on_wide(df: DataFrame, key: Column, order: Sequence[str], id_col: str) -> DataFrame:
    """``distinct_on`` for rows or keys too wide to sort and shuffle twice.

    The winner is picked on (digest of the key, order columns, id) only, then the
    full rows are fetched by ``id_col``, which must be unique.
    """
    narrow = df.select(F.sha2(key.cast("binary"), 256).alias("_digest"),
                       *dict.fromkeys([*order, id_col]))
    winners = distinct_on(narrow, ["_digest"], [F.col(c) for c in order]).select(id_col)
    return df.join(winners, id_col, "left_semi")


def first_per_group(df: DataFrame, key: str, value: Column, order: Column) -> DataFrame:
    """``value`` of the first record per key; ``min_by`` combines map-side."""
    return df.groupBy(key).agg(F.min_by(value, order).alias("first_value"))
