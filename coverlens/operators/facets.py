"""Linked facets: counts per key under selections, totals, newest rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Selections = Mapping[str, Sequence]


def _mask(column: str, values: Sequence) -> Column:
    # a NULL key is simply not selected; without the default it would void the sum
    return F.coalesce(F.col(column).isin(list(values)), F.lit(False))


def selected(selections: Selections, extra: Column | None = None,
             but: str | None = None) -> Column:
    """OR within a dimension, AND across dimensions.  No selection selects all.

    ``but`` leaves one dimension's own selection out; ``extra`` is any further
    predicate (a keyword or a date range) and is always applied.
    """
    masks = [_mask(d, v) for d, v in selections.items() if v and d != but]
    if extra is not None:
        masks.append(F.coalesce(extra, F.lit(False)))
    return reduce(lambda a, b: a & b, masks, F.lit(True))


def filter_selected(df: DataFrame, selections: Selections, extra: Column | None = None) -> DataFrame:
    """As a plain filter, so that scans can use the pushed-down IN lists."""
    for d, v in selections.items():
        if v:
            df = df.filter(F.col(d).isin(list(v)))
    return df if extra is None else df.filter(extra)


def total(df: DataFrame, selections: Selections, extra: Column | None = None) -> DataFrame:
    return df.agg(F.count_if(selected(selections, extra)).alias("n"))


def facet_sum(df: DataFrame, dim: str, value: Column | None = None) -> DataFrame:
    """Sum of ``value`` (default: one per row) per key of one dimension."""
    return df.groupBy(F.col(dim).alias("key")).agg(F.sum(value if value is not None else F.lit(1)).alias("n"))


TOTAL = "total"


def crossfilter(df: DataFrame, dims: Sequence[str], selections: Selections,
                extra: Column | None = None, tuples_first: bool = True,
                with_total: bool = False, weight: str | None = None) -> DataFrame:
    """(dim, key, n): per dimension, the rows under the selections of all *other*
    dimensions.  Keys whose count drops to zero stay.

    One scan for all dimensions.  ``tuples_first`` counts distinct combinations of
    the dimensions before they are unfolded into one row per dimension; right
    when combinations are far fewer than rows (attributes of an outlet).  Without
    it each row is unfolded at once; right for independent, high-cardinality
    dimensions.  Either way counts combine map-side, so a hot key is no hot task.
    ``with_total`` adds a row of dimension "total" with all selections applied.
    ``weight`` names a column with the number of rows that a row stands for.
    """
    every = F.lit(True) if extra is None else F.coalesce(extra, F.lit(False))
    count = F.lit(1) if weight is None else F.col(weight)
    rows = df.select(*dims, every.alias("_extra"), count.cast("bigint").alias("_n"))
    if tuples_first:
        rows = rows.groupBy(*dims, "_extra").agg(F.sum("_n").alias("_n"))

    def cell(dim: str, key: Column, but: str | None) -> Column:
        mask = selected(selections, F.col("_extra"), but)
        return F.struct(F.lit(dim).alias("dim"), key.cast("string").alias("key"),
                        F.when(mask, F.col("_n")).otherwise(F.lit(0)).cast("bigint").alias("n"))

    cells = [cell(d, F.col(d), d) for d in dims]
    if with_total:
        cells.append(cell(TOTAL, F.lit(""), None))
    unfolded = rows.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    return unfolded.groupBy("dim", "key").agg(F.sum("n").alias("n"))


def top_facet(facet: DataFrame, n: int) -> DataFrame:
    """The ``n`` keys with the highest counts of one facet, ties by key."""
    return facet.orderBy(F.desc("n"), F.asc("key")).limit(n)


PARTS = 32


def top_per_facet(facets: DataFrame, tops: Mapping[str, int]) -> DataFrame:
    """Top keys of every facet, each with its own limit.

    Ranked in two steps, first within PARTS parts of a facet's keys: whatever the limits,
    no task sorts all keys of a large facet, the last one at most PARTS times the limit.
    """
    order = [F.desc("n"), F.asc("key")]
    part = F.pmod(F.xxhash64("key"), F.lit(PARTS))
    first = F.row_number().over(Window.partitionBy("dim", "_part").orderBy(*order))
    rank = F.row_number().over(Window.partitionBy("dim").orderBy(*order))
    limit = F.lit(None).cast("int")
    for dim, n in tops.items():
        limit = F.when(F.col("dim") == dim, n).otherwise(limit)
    return (facets.filter(F.col("dim").isin(list(tops)))
            .withColumn("_part", part).withColumn("_first", first)
            .filter(F.col("_first") <= limit).drop("_part", "_first")
            .withColumn("rank", rank)
            .filter(F.col("rank") <= limit))


def distinct_keys(facets: DataFrame, caps: Mapping[str, int]) -> DataFrame:
    """Number of keys per facet, at most the facet's display limit."""
    cap = F.lit(None).cast("bigint")
    for dim, n in caps.items():
        cap = F.when(F.col("dim") == dim, F.lit(n).cast("bigint")).otherwise(cap)
    counted = facets.filter(F.col("dim").isin(list(caps))).groupBy("dim").agg(F.count("*").alias("n_keys"))
    return counted.select("dim", "n_keys", F.least(F.col("n_keys"), cap).alias("n_bars"))


def newest(df: DataFrame, selections: Selections, date: str, id_col: str, n: int = 60,
           extra: Column | None = None) -> DataFrame:
    """The ``n`` newest selected rows, ties by id: a bounded heap per task, no full sort."""
    return filter_selected(df, selections, extra).orderBy(F.desc(date), F.asc(id_col)).limit(n)


def nested_groups(df: DataFrame, properties: Sequence[str]) -> DataFrame:
    """Rows grouped by nested properties: one row per innermost group, in path order
    when sorted by the properties.  The members themselves stay in the table;
    ``writers.write_nested`` lays them out by the same path."""
    return df.groupBy(*properties).agg(F.count("*").alias("n"))


def nested_tree(df: DataFrame, properties: Sequence[str], member: Sequence[str], order: Sequence[Column], top: int) -> DataFrame:
    """One row per value of the first property: it, ``n`` (rows below) and ``children``, an array of structs of the same
    make for the next property, sorted by value (null first); below the last one ``members``: the first ``top`` rows by ``order``.

    Only ``top`` rows of an innermost group leave their tasks, so a group of any size stays cheap and its full
    count stands beside them.  Levels are built from the inside out; each needs one aggregation of what the
    level below left.  A property needs no more values below one parent than fit a row.
    """
    rank = F.row_number().over(Window.partitionBy(*properties).orderBy(*order))
    first = df.select(*properties, *member, rank.alias("_rank")).filter(F.col("_rank") <= top)
    listed = first.groupBy(*properties).agg(F.sort_array(F.collect_list(F.struct("_rank", *member))).alias("_members"))
    listed = listed.select(*[F.col(p).alias(f"_{p}") for p in properties],
                           F.transform("_members", lambda m: F.struct(*[m[c].alias(c) for c in member])).alias("members"))
    counted = nested_groups(df, properties)
    same = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in properties])
    level = counted.join(listed, same).select(*properties, "n", "members")
    for depth in range(len(properties) - 1, 0, -1):
        below = "members" if depth == len(properties) - 1 else "children"
        node = F.struct(properties[depth], "n", below)
        level = level.groupBy(*properties[:depth]).agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(node)).alias("children"))
    return level


def outcome_rate(df: DataFrame, success: Column, *by: str) -> DataFrame:
    """ok, failed and success share (percent) per group."""
    return df.groupBy(*by).agg(
        F.count_if(success).alias("n_ok"), F.count_if(~success).alias("n_failed"),
        (F.count_if(success) * 100.0 / F.count("*")).alias("pct_ok"),
    )
