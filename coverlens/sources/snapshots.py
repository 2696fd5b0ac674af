"""A table in hash partitions, changed by the rows that are new and read as of one snapshot.

``path``/data holds folders that are written once and never changed; ``path``/snapshots has one small table per
snapshot with the folders that each partition consists of.  A change writes new folders for the
partitions it touches and then, as its last step, a new snapshot: readers see the old one or
the new one, and an attempt that fails leaves folders that nothing names.

One writer at a time: of two that start from the same snapshot the second one's changes would win.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverlens.operators.dedup import distinct_on
from coverlens.sources import files

PART, HASH, REPLACES = "_part", "_hash", "_replaces"
PARTS = 64        # hash partitions of a table; fixed by its first snapshot
MOST_FOLDERS = 8  # a partition of more folders is written anew


@dataclass(frozen=True)
class Snapshot:
    """``folders`` lists per partition where its rows are; ``note`` is the writer's own."""

    number: int
    parts: int
    note: str = ""
    folders: dict[int, list[str]] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.number:09d}"


def _snapshot(spark: SparkSession, path: str, name: str) -> Snapshot:
    rows = spark.read.schema("number int, parts int, note string, part int, folder string").json(f"{path}/snapshots/{name}").collect()
    folders: dict[int, list[str]] = defaultdict(list)
    for r in rows:
        if r["part"] is not None:
            folders[r["part"]].append(r["folder"])
    return Snapshot(rows[0]["number"], rows[0]["parts"], rows[0]["note"], {p: sorted(f) for p, f in folders.items()})


def latest(spark: SparkSession, path: str) -> Snapshot | None:
    """The newest snapshot that was written out, None before the first."""
    names = files.complete(spark, f"{path}/snapshots")
    return _snapshot(spark, path, names[-1]) if names else None


def _commit(spark: SparkSession, path: str, snapshot: Snapshot) -> Snapshot:
    rows = [(snapshot.number, snapshot.parts, snapshot.note, part, folder) for part, names in snapshot.folders.items() for folder in names]
    rows = rows or [(snapshot.number, snapshot.parts, snapshot.note, None, None)]
    # half-written snapshots of earlier attempts have no _SUCCESS and give way
    (spark.createDataFrame(rows, "number int, parts int, note string, part int, folder string").coalesce(1)
     .write.mode("overwrite").json(f"{path}/snapshots/{snapshot.name}"))
    return snapshot


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(HASH, T.LongType()), T.StructField(REPLACES, T.BooleanType())])


def _read(spark: SparkSession, path: str, schema: T.StructType, snapshot: Snapshot | None, parts: Sequence[int] | None = None) -> DataFrame:
    chosen = snapshot.folders if snapshot else {}
    names = [f"{path}/data/{folder}" for part, folders in sorted(chosen.items()) for folder in folders if parts is None or part in parts]
    if not names:
        return spark.createDataFrame([], _stored(schema))
    return spark.read.schema(_stored(schema)).parquet(*names)


def read(spark: SparkSession, path: str, schema: T.StructType, snapshot: Snapshot | None = None) -> DataFrame:
    """The rows of a snapshot, the newest by default; no rows before the first."""
    return _read(spark, path, schema, snapshot or latest(spark, path)).select(*schema.names)


def _part_of(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def _write(rows: DataFrame, path: str, attempt: str, key: str, parts: int) -> dict[int, str]:
    """Write rows to a new folder, one below it per partition; partition numbers and their folders."""
    spark = rows.sparkSession
    (rows.withColumn(PART, _part_of(key, parts)).hint("rebalance", PART)
     .write.partitionBy(PART).parquet(f"{path}/data/{attempt}"))
    return {int(name.removeprefix(f"{PART}=")): f"{attempt}/{name}"
            for name in files.folders(spark, f"{path}/data/{attempt}") if name.startswith(f"{PART}=")}


def _attempt() -> str:
    return uuid.uuid4().hex[:16]


def _hashed(rows: DataFrame, schema: T.StructType, ignore: Sequence[str]) -> DataFrame:
    return rows.select(*schema.names).withColumn(HASH, F.xxhash64(*[c for c in schema.names if c not in ignore]))


def rebuild(rows: DataFrame, path: str, schema: T.StructType, key: str, note: str = "", parts: int = PARTS,
            ignore: Sequence[str] = ()) -> Snapshot:
    """A snapshot of exactly these rows, which are unique on ``key``."""
    spark, old = rows.sparkSession, latest(rows.sparkSession, path)
    parts = old.parts if old else parts
    found = _write(_hashed(rows, schema, ignore).withColumn(REPLACES, F.lit(False)), path, _attempt(), key, parts)
    return _commit(spark, path, Snapshot((old.number if old else 0) + 1, parts, note, {p: [f] for p, f in found.items()}))


def merge(rows: DataFrame, path: str, schema: T.StructType, key: str, order: Sequence[str], same: str, note: str = "",
          parts: int = PARTS, ignore: Sequence[str] = ()) -> Snapshot:
    """A snapshot in which ``rows`` are taken in: per ``key`` the first by ``order`` stays.

    A row whose ``same`` (the record it was made from) equals the stored one's replaces it, unless all columns but those
    in ``ignore`` are equal; then nothing is written for it, so a repeated merge changes nothing.
    Of the stored rows only key, order and hash are read, in the partitions that ``rows`` touch.  New keys become a
    further folder of their partition; a partition is written anew only if a stored row is replaced or it has
    more than MOST_FOLDERS folders.  Rows without a key are not taken.
    """
    spark, old = rows.sparkSession, latest(rows.sparkSession, path)
    parts, number = (old.parts, old.number + 1) if old else (parts, 1)
    keyed = rows.filter(F.col(key).isNotNull())
    first = distinct_on(_hashed(keyed, schema, ignore), [key], [*map(F.col, order), F.col(HASH)])
    # at most one number a partition; of the first snapshot there is nothing to read
    touched = [r[0] for r in keyed.select(_part_of(key, parts)).distinct().collect()] if old else []
    known = _read(spark, path, schema, old, touched).select(
        key, F.struct(*order).alias("_order"), F.col(same).alias("_same"), F.col(HASH).alias("_stored"))
    beside = first.join(known, key, "left")
    newer = F.col("_same").eqNullSafe(F.col(same)) & (F.col("_stored") != F.col(HASH))
    earlier = ~F.col("_same").eqNullSafe(F.col(same)) & (F.struct(*order) < F.col("_order"))
    taken = beside.filter(F.col("_stored").isNull() | newer | earlier).withColumn(REPLACES, F.col("_stored").isNotNull())
    attempt = _attempt()
    added = _write(taken.select(*schema.names, HASH, REPLACES), path, attempt, key, parts)
    if not added and old and old.note == note:
        files.remove(spark, f"{path}/data/{attempt}")
        return old
    folders = {part: list(names) for part, names in old.folders.items()} if old else {}
    if added:
        fresh = spark.read.schema(_stored(schema)).parquet(*[f"{path}/data/{f}" for f in added.values()])
        replaced = fresh.filter(REPLACES).select(key)
        anew = {r[0] for r in replaced.select(_part_of(key, parts)).distinct().collect()}
        anew |= {part for part in added if len(folders.get(part, [])) >= MOST_FOLDERS}
        anew &= set(folders)
        if anew:
            left = _read(spark, path, schema, old, sorted(anew)).withColumn(REPLACES, F.lit(False)).join(replaced, key, "left_anti")
            rest = _write(left.select(*schema.names, HASH, REPLACES), path, f"{attempt}-rest", key, parts)
            for part in anew:
                folders[part] = [rest[part]] if part in rest else []
    for part, folder in added.items():
        folders[part] = [*folders.get(part, []), folder]
    return _commit(spark, path, Snapshot(number, parts, note, folders))


def at(spark: SparkSession, path: str, number: int) -> Snapshot | None:
    """The snapshot of that number, None where it has expired."""
    name = Snapshot(number, 0).name
    return _snapshot(spark, path, name) if name in files.complete(spark, f"{path}/snapshots") else None


def changes(spark: SparkSession, path: str, schema: T.StructType, key: str, old: Snapshot, new: Snapshot) -> tuple[DataFrame, DataFrame]:
    """(added, removed) rows from one snapshot to another; a row that changed is in both.

    Only folders that one of the two has and the other has not are read.
    """
    def only(a: Snapshot, b: Snapshot) -> DataFrame:
        differ = {part: [f for f in folders if f not in b.folders.get(part, [])] for part, folders in a.folders.items()}
        return _read(spark, path, schema, Snapshot(a.number, a.parts, a.note, differ))

    there, gone = only(new, old), only(old, new)
    # what was only moved to another folder is on both sides
    left = lambda a, b: a.join(b.select(key, HASH), [key, HASH], "left_anti").select(*schema.names)
    return left(there, gone), left(gone, there)


def expire(spark: SparkSession, path: str, keep: int = 3) -> int:
    """Remove all snapshots but the latest ``keep`` and every folder that none of these names; how many folders went.

    A reader of an older snapshot loses its files, so ``keep`` should cover the snapshots written while the longest
    reader runs.  Not to run beside a writer.
    """
    if keep < 1:
        raise ValueError("keep at least the current snapshot")
    kept = files.complete(spark, f"{path}/snapshots")[-keep:]
    named = {folder for name in kept for folders in _snapshot(spark, path, name).folders.values() for folder in folders}
    for name in files.folders(spark, f"{path}/snapshots"):
        if name not in kept:
            files.remove(spark, f"{path}/snapshots/{name}")
    gone = 0
    for attempt in files.folders(spark, f"{path}/data"):
        below = [f"{attempt}/{name}" for name in files.folders(spark, f"{path}/data/{attempt}")]
        if not any(folder in named for folder in below):
            files.remove(spark, f"{path}/data/{attempt}")
            gone += len(below)
            continue
        for folder in below:
            if folder not in named:
                files.remove(spark, f"{path}/data/{folder}")
                gone += 1
    return gone
