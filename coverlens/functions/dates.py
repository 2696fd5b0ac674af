"""Date parsing and defaults without exceptions (ANSI mode is on in Spark 4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from coverlens import schemas as S

_ISO = r"^\d{4}-\d{1,2}-\d{1,2}( \d{1,2}:\d{1,2}:\d{1,2})?$"
_US = r"^\d{1,2}/\d{1,2}/(\d{4}|\d{2})$"
CENTURY_PIVOT = "69"  # two-digit years from here on are 19xx


def parse_date(value: Column) -> Column:
    """``2024-02-15 14:30:00``, ``2024-02-15``, ``2/15/2024`` or ``2/15/24``, else NULL.

    Parts need no zero padding; impossible dates give NULL.  The result has no zone.
    """
    month, day_, year = (F.split_part(value, F.lit("/"), F.lit(i)) for i in (1, 2, 3))
    century = F.when(F.length(year) == 4, "").when(year >= CENTURY_PIVOT, "19").otherwise("20")
    us = F.concat(century, year, F.lit("-"), month, F.lit("-"), day_)
    return (F.when(value.rlike(_ISO), value.try_cast("timestamp_ntz"))
            .when(value.rlike(_US), us.try_cast("timestamp_ntz")))


def parse_page_date(value: Column) -> Column:
    """ISO 8601 as found in page metadata (the wall-clock time; an offset is dropped)."""
    iso = F.regexp_extract(value, r"^\s*(\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2})?)?)", 1)
    return F.coalesce(iso.try_cast("timestamp_ntz"), parse_date(F.trim(value)))


def normalize_timestamp(value: Column) -> Column:
    """A timestamp stays, a date becomes its midnight, anything else NULL."""
    return value.try_cast("timestamp_ntz")


def day(value: Column) -> Column:
    """Calendar day of a feed's date string, in any format of ``parse_date`` (or of a date/timestamp), else NULL."""
    return F.coalesce(value.try_cast("date"), parse_date(value.cast("string")).cast("date"))


def publish_day(value: Column) -> Column:
    return F.coalesce(day(value), F.lit(S.DEFAULT_DATE).cast("date"))


def run_timestamp(run_ts: dt.datetime | None = None) -> Column:
    """The run's fixed time, or now.  Pass one for repeatable runs.

    A literal by text: a Python datetime would be taken as an instant and shift
    with the session's zone."""
    return F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz") if run_ts else F.localtimestamp()
