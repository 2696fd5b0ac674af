"""Connected components of an edge table: union-find within partitions, then star contraction across them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens.llm.common import written

MAX_ROUNDS = 100


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A partition's edges as stars around each part's smallest node; grows with its distinct nodes."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for a, b in zip(batch["u"].tolist(), batch["v"].tolist()):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    stars = [(node, find(node)) for node in list(root) if find(node) != node]
    yield pd.DataFrame(stars, columns=["u", "v"], dtype="int64")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v: longs); component is its smallest node.

    Large-star and small-star steps alternate until every edge leads to its component.  Neighbour
    minima are aggregated map-side, so a node with very many edges costs no single task.
    Every round is written to the shared folder.  Nodes without an edge have no row.
    """
    now = written(edges.select(F.col("u").cast("long"), F.col("v").cast("long")).filter("u <> v")
                  .mapInPandas(_forest, "u long, v long"), "edges")
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.filter("u > v").distinct()
        # every node's smaller neighbours meet at the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("low").alias("v")), F.struct("u", F.col("low").alias("v")))).alias("e"))
            .select("e.*").filter("u > v").distinct())
        following = written(small, "edges")
        changed = not (following.exceptAll(now).isEmpty() and now.exceptAll(following).isEmpty())
        now = following
        if not changed:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
