"""Table schemas, default members and keys.

Spark does not enforce PRIMARY KEY, UNIQUE or FOREIGN KEY on files; those rules
live as jobs in ``coverlens.operators.audit``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_ID = 1  # the "Unspecified" / "None" / "Other" member of every dimension
DEFAULT_DATE = "2000-01-01"
DEFAULT_LANGUAGE = "en"
UNSPECIFIED = "Unspecified"


_TYPES = {"string": T.StringType(), "timestamp_ntz": T.TimestampNTZType(), "date": T.DateType(),
          "boolean": T.BooleanType(), "int": T.IntegerType(), "bigint": T.LongType()}


def _schema(**fields: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in fields.items()])


FEED = _schema(id="string", publish_date="string", title="string", url="string",
               language="string", media_url="string")

ARTICLE = _schema(story_id="string", import_date="timestamp_ntz", title="string", text="string",
                  publish_date="timestamp_ntz", authors="string", top_image="string",
                  summary="string", success="boolean", error="string")

SENTENCE = _schema(story_id="string", import_date="timestamp_ntz", sentence="string")

PAGE = _schema(id="string", url="string", html="string")

OUTLET_CSV = _schema(name="string", domain_name="string", media_outlet_type="string",
                     state="string", bias="string", active="boolean")

OUTLET = _schema(id="bigint", edit_time="timestamp_ntz", media_outlet_type_id="int",
                 state_id="int", bias_rating_id="int", name="string", domain_name="string",
                 note="string", active="boolean")

STORY = _schema(id="string", edit_time="timestamp_ntz", syndicator_id="int",
                media_outlet_id="bigint", feed_id="string", url="string", publish_date="date",
                title="string", language="string", authors="string", image="string",
                body="string", sentence="string", summary="string", active="boolean")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name, in schema order; an absent column becomes NULL.

    The first column is the key: a table without it is refused, not filled with NULLs."""
    have = set(df.columns)
    if schema.fields[0].name not in have:
        raise ValueError(f"no column {schema.fields[0].name} among {sorted(have)}")
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def story_key(url: Column) -> Column:
    """Stable story key: the same URL keeps its key across rebuilds."""
    return F.md5(url.cast("binary"))


def outlet_key(domain: Column) -> Column:
    """60-bit key of an outlet domain; compact in the fact table, clear of id 1."""
    return F.conv(F.substring(F.md5(domain.cast("binary")), 1, 15), 16, 10).cast("bigint")
