"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import lru_cache, wraps

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_BYTES = 4 * 1024 * 1024
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_UNITS = {"k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}

# AQE sizes reduce tasks, turns joins into broadcasts once a side is seen to be
# small, and splits skewed sort-merge partitions; nothing here depends on data size.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    _BATCH: str(BATCH_BYTES),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # call sites in error messages cost a few round trips per expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "coverlens", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; ``extra`` overrides use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of a few MB, however long their texts are."""
    given = spark.conf.get(_BATCH).lower().rstrip("b")
    if not 0 < int(given.rstrip("kmgt")) * _UNITS.get(given[-1], 1) <= BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def batched_udf(returns: T.DataType | str) -> Callable[[Callable], Callable[..., Column]]:
    """``pandas_udf`` over texts: using it gives the session small batches, so a worker's memory does not follow
    the length of the texts and the number of rows of a task."""
    def make(function: Callable) -> Callable[..., Column]:
        made = F.pandas_udf(function, returns)

        @wraps(function)
        def column(*values: Column) -> Column:
            small_batches(SparkSession.active())
            return made(*values)
        return column
    return make


@lru_cache(maxsize=1)
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="coverlens-")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the cluster's shared folder (``spark.checkpoint.dir``).

    Only a ``local`` master without that setting falls back to a temporary
    folder: on a cluster a machine-local path would be lost with its executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/coverlens/{name}-{uuid.uuid4().hex[:12]}"
