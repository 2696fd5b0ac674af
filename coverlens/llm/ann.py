"""Approximate nearest neighbours: cross-polytope hashing with multiprobe tables and exact reranking.

Vectors are grouped by ranges of length; within one, largest inner product is nearly smallest angle.
Ranges of few vectors are compared with every query.  A fast pseudo-rotation (signs and Hadamard transforms) then assigns a
vector to the nearest signed axis; queries probe the axes nearest to them in every table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverlens.llm.common import written

TABLES, PROBES = 8, 16
CELL_ROWS = 20_000   # vectors of one cell compared in one task; larger cells are split, queries go to every part
CELL_QUERIES = 5_000  # queries of one cell in one task; more are split, each part meets all of the cell's vectors
RANGE = 1.2          # factor between the lengths of the longest and the shortest vector of a range
FEW_ROWS = 1_000     # ranges up to this size are compared with every query, unless they are a large part of the table
NEAREST = 20
QUERY_STEP = 20


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of every row (a power of two long), scaled to keep lengths."""
    n, width = x.shape
    step = 1
    while step < width:
        x = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x / math.sqrt(width)


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    """Three rounds of random signs and a Hadamard transform."""
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], size=(3, x.shape[1]))
    for s in signs:
        x = hadamard(x * s)
    return x


class Index:
    """Cells are the signed axes of a table, whatever the number of vectors: finer ones would leave a query fewer candidates."""

    def __init__(self, dimension: int, tables: int = TABLES, probes: int = PROBES):
        self.tables, self.probes = tables, probes
        self.width = 1 << dimension.bit_length()
        self.axes = 1 << (dimension.bit_length() - 1)      # rotated coordinates that count

    def _placed(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), self.width))
        out[:, :x.shape[1]] = x / np.linalg.norm(x, axis=1)[:, None]
        return out

    def _sides(self, placed: np.ndarray, table: int) -> np.ndarray:
        """Closeness to each signed axis: 2 * axes columns."""
        y = rotate(placed, 1000 * table)[:, :self.axes]
        return np.concatenate([y, -y], axis=1)

    def cells(self, x: np.ndarray, table: int) -> np.ndarray:
        return np.argmax(self._sides(self._placed(x), table), axis=1).astype(np.int64)

    def probed(self, x: np.ndarray, table: int) -> np.ndarray:
        """The cells nearest to each query, at most ``probes``."""
        sides = self._sides(self._placed(x), table)
        return np.argsort(-sides, axis=1, kind="stable")[:, :self.probes].astype(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _nearest(queries: pd.DataFrame, rows: pd.DataFrame, most: int) -> pd.DataFrame:
    """Of each query the ``most`` nearest rows: largest inner product, then smallest id."""
    none = pd.DataFrame({"query_id": [], "id": [], "score": []}).astype({"query_id": "int64", "id": "int64", "score": "float64"})
    if len(queries) == 0 or len(rows) == 0:
        return none
    rows = rows.sort_values("id")
    x, ids = np.stack(rows["vector"].to_numpy()).astype(np.float64), rows["id"].to_numpy()
    out = []
    for query, q in zip(queries["query_id"], np.stack(queries["vector"].to_numpy()).astype(np.float64)):
        score = (x * q).sum(axis=1)  # the same rounding wherever a pair meets
        keep = np.argpartition(-score, most - 1)[:most] if len(score) > most else np.arange(len(score))
        if len(score) > most:  # all that tie with the last one
            keep = np.flatnonzero(score >= score[keep].min())
        keep = keep[np.lexsort((ids[keep], -score[keep]))][:most]
        out.append(pd.DataFrame({"query_id": query, "id": ids[keep], "score": score[keep]}))
    return pd.concat(out)


def _length_range() -> Column:
    """The number of the range that a vector's length falls into; null where its square is not a usable number."""
    square = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v)
    return F.when((square > 1e-300) & (square < 1e300), F.round(F.log(square) / (2 * math.log(RANGE))).cast("int"))


def _searched_ranges(classes: DataFrame, n: int) -> list[int]:
    """Ranges searched by cells, fewer than 128; the vectors of all others are compared with every query."""
    few = max(n / 128, min(FEW_ROWS, n / 8))
    sizes = classes.groupBy(_length_range().alias("range")).agg(F.count("*").alias("n"))
    return [r["range"] for r in sizes.filter(F.col("range").isNotNull() & (F.col("n") > few)).collect()]


def _search(classes: DataFrame, queries: DataFrame, index: Index, ranges: list[int], most: int) -> DataFrame:
    """(query_id, id, score): candidates from all probed cells, ``most`` of each cell at most.

    Cells are those of each range in ``ranges``; table -1 has one cell for the vectors of all others.
    """
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"))
            for table in range(index.tables if len(x) else 0):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), table, np.int32)), batch.column("range"), pa.array(index.cells(x, table)),
                     batch.column("id"), batch.column("vector")], ["table", "range", "cell", "id", "vector"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"))
            for table in range(index.tables if len(x) else 0):
                cells = index.probed(x, table)
                again = pa.array(np.repeat(np.arange(len(x)), cells.shape[1]))
                for number in ranges:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(cells.size, table, np.int32)), pa.array(np.full(cells.size, number, np.int32)),
                         pa.array(cells.ravel()), batch.column("query_id").take(again), batch.column("vector").take(again)],
                        ["table", "range", "cell", "query_id", "vector"])

    by_range = classes.select("id", "vector", _length_range().alias("range"))
    in_cells = F.coalesce(F.col("range").isin(ranges), F.lit(False))
    alone = [F.lit(-1).alias("table"), F.lit(0).alias("range"), F.lit(0).cast("long").alias("cell")]
    placed = (by_range.filter(in_cells)
              .mapInArrow(place, "table int, range int, cell long, id long, vector array<double>")
              .unionByName(by_range.filter(~in_cells).select(*alone, "id", "vector")))
    asked = (queries.select("query_id", "vector")
             .mapInArrow(probe, "table int, range int, cell long, query_id long, vector array<double>")
             .unionByName(queries.select(*alone, "query_id", "vector")))
    cell = ["table", "range", "cell"]
    parts = lambda frame, size, name: frame.groupBy(*cell).agg(F.ceil(F.count("*") / size).cast("int").alias(name))
    full = written(parts(placed, CELL_ROWS, "pieces").join(parts(asked, CELL_QUERIES, "shares"), cell), "cells")
    own = lambda column, of: F.pmod(F.xxhash64(column), F.col(of)).cast("int")
    each = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    rows = placed.join(full, cell).withColumn("piece", own("id", "pieces")).withColumn("share", each("shares"))
    asked = asked.join(full, cell).withColumn("piece", each("pieces")).withColumn("share", own("query_id", "shares"))
    key = [*cell, "piece", "share"]
    return (asked.select(*key, "query_id", "vector").groupBy(*key)
            .cogroup(rows.select(*key, "id", "vector").groupBy(*key))
            .applyInPandas(lambda q, x: _nearest(q, x, most), "query_id long, id long, score double"))


def _top(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return (found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most))


def nearest_neighbours(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
                       nearest: int = NEAREST, query_step: int = QUERY_STEP,
                       tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score) of the queries, rows whose key is divisible by ``query_step``.

    Score is the inner product in double precision; ties go to the smaller key.  Rows without a
    key, and vectors that are null, empty, zero, of another length than most, or that hold a null or a
    non-finite component take no part.  Repeated rows (equal key and vector) count once; equal
    vectors under different keys are all found.  A query that its cells leave with fewer than
    ``nearest`` candidates is compared with all vectors.  An empty table has no rows.
    """
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    plain = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    plain = plain.filter(F.col("id").isNotNull() & (F.size("vector") > 0) & ~F.exists("vector", bad)
                         & F.exists("vector", lambda v: v != 0))
    kind = plain.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    dimension = kind["d"] if kind else 1
    valid = written(plain.filter(F.size("vector") == dimension), "vectors")
    # equal vectors are one class, named by its smallest key; of its keys only as many as a query may need go on
    classes = written(valid.groupBy("vector").agg(F.min("id").alias("id")), "classes")
    by_id = Window.partitionBy("vector").orderBy("id")
    members = (valid.dropDuplicates(["id", "vector"]).withColumn("place", F.row_number().over(by_id))
               .filter(F.col("place") <= nearest + 1)
               .withColumn("class", F.min("id").over(Window.partitionBy("vector"))).select(F.col("id").alias("vec_id"), "class"))
    # equal query vectors are searched once, as their class
    queries = written(valid.filter(F.col("id") % query_step == 0).dropDuplicates(["id", "vector"]).withColumnRenamed("id", "vec_id")
                      .join(classes.withColumnRenamed("id", "query_class"), "vector"), "queries")
    asked = queries.groupBy(F.col("query_class").alias("query_id")).agg(F.first("vector").alias("vector"))
    n = classes.count()
    index, ranges = Index(dimension, tables, probes), _searched_ranges(classes, n)
    found = written(_top(_search(classes, asked, index, ranges, nearest + 1), nearest + 1), "found")
    wanted = min(nearest + 1, n)
    short = found.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= wanted)
    rest = written(asked.join(short, "query_id", "left_anti"), "rest")
    if not rest.isEmpty():
        every = _search(classes, rest, index, [], nearest + 1)
        found = found.join(rest.select("query_id").distinct(), "query_id", "left_anti").unionByName(_top(every, nearest + 1))
    found = queries.select(F.col("vec_id").alias("query_id"), "query_class").join(
        found.withColumnRenamed("query_id", "query_class").drop("rank"), "query_class").drop("query_class")
    own = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.select("query_id", F.col("id").alias("class"), "score").join(members, "class")
            .filter("vec_id <> query_id").withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= nearest)
            .select("query_id", "rank", "vec_id", "score"))
