"""What several operators of this subpackage share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.session import small_batches, work_path

# A word is a run of bytes other than ASCII white space (space, tab to carriage return).
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 5


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` as a table in the shared folder: cuts the lineage, survives lost executors."""
    small_batches(frame.sparkSession)
    path = work_path(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for a null text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), 0)


def bound(value: Column, expression) -> Column:
    """``expression(value)`` with the value computed once per row, also inside its lambdas."""
    return F.transform(F.array(value), expression)[0]


def hash_order(*parts: Column) -> Column:
    """A fixed pseudo-random key (16 hex digits) from the parts; SQL engines with md5 agree on it."""
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, 16)


# --- 64-bit hashes over numpy arrays, for use inside tasks -----------------------------

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 2**64)
_BYTE_VALUES = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64)
_POWERS: dict[int, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """An avalanche step: equal inputs stay equal, all output bits depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept between calls."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        known = _POWERS[base] = np.cumprod(steps)
    return known[:n]


def running_sums(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums over 64-bit values, one more than there are values."""
    prefix = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _powers(_MULTIPLIER, len(values)), out=prefix[1:])
    return prefix


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums over bytes (uint8), one more than there are bytes."""
    return running_sums(_BYTE_VALUES[data])


def substring_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each substring [start, end); equal content has equal hashes, wherever it stands."""
    return mix64((prefix[ends] - prefix[starts]) * _powers(_INVERSE, len(prefix))[starts])
