"""Reading landed feeds and raw pages; the window of the next pull."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverlens import schemas as S
from coverlens.functions import dates


def read_feed(spark: SparkSession, path: str, start: dt.date | None = None,
              end: dt.date | None = None, fmt: str = "json") -> DataFrame:
    """Landed story records of a date window, inclusive at both ends."""
    return in_window(spark.read.schema(S.FEED).format(fmt).load(path), start, end)


def in_window(feed: DataFrame, start: dt.date | None, end: dt.date | None) -> DataFrame:
    published = dates.day(F.col("publish_date"))
    if start is not None:
        feed = feed.filter(published >= F.lit(start))
    return feed if end is None else feed.filter(published <= F.lit(end))


NO_DATE = "no publish date"


def undated(feed: DataFrame) -> DataFrame:
    """Records that no window can hold, as their date does not parse; with the ``reason``."""
    return feed.filter(dates.day(F.col("publish_date")).isNull()).withColumn("reason", F.lit(NO_DATE))


def read_pages(spark: SparkSession, path: str, id_col: str = "page_id") -> DataFrame:
    """Crawled pages as (id, url, html)."""
    return spark.read.parquet(path).select(F.col(id_col).cast("string").alias("id"), "url", "html")


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A staging table, empty while nothing has been written to it."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def high_watermark(feed: DataFrame) -> DataFrame:
    """Latest publish day.  Cast before MAX: the maximum of strings is lexical."""
    return feed.agg(F.max(dates.day(F.col("publish_date"))).alias("max_date"))


def next_window(feed: DataFrame, today: dt.date, start: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """The next pull starts *on* the last stored day (overlap is removed by id) and
    ends today.  ``start`` is used while nothing is stored."""
    last = high_watermark(feed).first()["max_date"]
    if last is None and start is None:
        raise ValueError("nothing stored yet: give a start date")
    return (last or start, today)
