"""Static dimensions and the outlet dimension."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens import schemas as S
from coverlens.functions import dates
from coverlens.operators.dedup import distinct_on
from coverlens.operators.lookup import resolve_names

# --- Fixed values: dimension members, (id, name, code or ordering, ...) --------------
STATES = [
    (1, "Unspecified", "", False),
    (2, "Alabama", "AL", True), (3, "Alaska", "AK", True), (4, "Arizona", "AZ", True),
    (5, "Arkansas", "AR", True), (6, "California", "CA", True), (7, "Colorado", "CO", True),
    (8, "Connecticut", "CT", True), (9, "Delaware", "DE", True), (10, "Florida", "FL", True),
    (11, "Georgia", "GA", True), (12, "Hawaii", "HI", True), (13, "Idaho", "ID", True),
    (14, "Illinois", "IL", True), (15, "Indiana", "IN", True), (16, "Iowa", "IA", True),
    (17, "Kansas", "KS", True), (18, "Kentucky", "KY", True), (19, "Louisiana", "LA", True),
    (20, "Maine", "ME", True), (21, "Maryland", "MD", True), (22, "Massachusetts", "MA", True),
    (23, "Michigan", "MI", True), (24, "Minnesota", "MN", True), (25, "Mississippi", "MS", True),
    (26, "Missouri", "MO", True), (27, "Montana", "MT", True), (28, "Nebraska", "NE", True),
    (29, "Nevada", "NV", True), (30, "New Hampshire", "NH", True), (31, "New Jersey", "NJ", True),
    (32, "New Mexico", "NM", True), (33, "New York", "NY", True),
    (34, "North Carolina", "NC", True), (35, "North Dakota", "ND", True), (36, "Ohio", "OH", True),
    (37, "Oklahoma", "OK", True), (38, "Oregon", "OR", True), (39, "Pennsylvania", "PA", True),
    (40, "Rhode Island", "RI", True), (41, "South Carolina", "SC", True),
    (42, "South Dakota", "SD", True), (43, "Tennessee", "TN", True), (44, "Texas", "TX", True),
    (45, "Utah", "UT", True), (46, "Vermont", "VT", True), (47, "Virginia", "VA", True),
    (48, "Washington", "WA", True), (49, "West Virginia", "WV", True),
    (50, "Wisconsin", "WI", True), (51, "Wyoming", "WY", True),
    (52, "District of Columbia", "DC", False),
    (53, "American Samoa", "AS", False), (54, "Guam", "GU", False),
    (55, "Northern Mariana Islands", "MP", False), (56, "Puerto Rico", "PR", False),
    (57, "US Virgin Islands", "VI", False),
    (58, "UK", "UK", False),
]
SYNDICATORS = [(1, "None", "None")]
MEDIA_TYPES = [
    (1, "Other", "other"),
    (2, "Web Publication", "digital_native"),
    (3, "Local News Outlet", "print_native"),
    (4, "National News Outlet", "video_broadcast"),
    (5, "Network TV News", "twitter"),
    (6, "Cable TV News", "usg_agency"),
    (7, "Opinion Journal", "facebook"),
    (8, "Advocacy Group", "advocacy_group"),
    (9, "Local Broadcast News", "local_publication"),
    (10, "Court Documents", "court_documents"),
    (11, "Blog", "blog"),
]
BIAS_RATINGS = [
    (1, "Unspecified", 0), (2, "Left", 1), (3, "Center Left", 2), (4, "Center", 3),
    (5, "Mixed", 3), (6, "Center Right", 4), (7, "Right", 5),
]
# --- end of fixed values -------------------------------------------------------------


def sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return str(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP_NTZ '{value:%Y-%m-%d %H:%M:%S}'"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def inline_rows(spark: SparkSession, rows: Iterable[tuple], columns: str) -> DataFrame:
    """A literal relation; the optimizer knows its exact size."""
    body = ", ".join("(" + ", ".join(sql_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({columns})")


# The four dimensions below are literal rows, so their size is proven: broadcast.

def states(spark: SparkSession) -> DataFrame:
    return F.broadcast(inline_rows(spark, STATES, "id, name, code, is_state"))


def syndicators(spark: SparkSession) -> DataFrame:
    return F.broadcast(inline_rows(spark, SYNDICATORS, "id, name, code"))


def media_types(spark: SparkSession) -> DataFrame:
    return F.broadcast(inline_rows(spark, MEDIA_TYPES, "id, name, feed_code"))


def bias_ratings(spark: SparkSession) -> DataFrame:
    return F.broadcast(inline_rows(spark, BIAS_RATINGS, "id, name, ordering"))


def static_dimensions(spark: SparkSession, edit_time: dt.datetime | None = None) -> dict[str, DataFrame]:
    """The four literal dimensions, stamped with ``edit_time`` (default: now)."""
    stamp = dates.run_timestamp(edit_time)
    frames = {
        "state": states(spark),
        "syndicator": syndicators(spark),
        "media_outlet_type": media_types(spark),
        "bias_rating": bias_ratings(spark),
    }
    return {name: df.withColumn("edit_time", stamp) for name, df in frames.items()}


def read_outlets_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Outlet CSV with a header.  The declared schema avoids the extra pass of inference."""
    reader = (spark.read.option("header", True).option("escape", '"')
              .option("multiLine", True))
    if infer:
        return reader.option("inferSchema", True).csv(path)
    return reader.option("enforceSchema", False).schema(S.OUTLET_CSV).csv(path)


def member_row(name: str, domain_name: str, media_outlet_type_id: int = S.DEFAULT_ID,
               state_id: int = S.DEFAULT_ID, bias_rating_id: int = S.DEFAULT_ID,
               note: str = "", active: bool = True, id: int | None = None) -> dict:
    """An outlet given by hand, already in terms of dimension ids."""
    return dict(id=id, name=name, domain_name=domain_name,
                media_outlet_type_id=media_outlet_type_id, state_id=state_id,
                bias_rating_id=bias_rating_id, note=note, active=active)


UNSPECIFIED_OUTLET = member_row(S.UNSPECIFIED, "None", id=S.DEFAULT_ID)


def add_members(spark: SparkSession, outlets: DataFrame, members: Iterable[Mapping]) -> DataFrame:
    """Append literal member rows; a member without an id gets its domain's key."""
    names = list(UNSPECIFIED_OUTLET)
    rows = inline_rows(spark, [tuple(m[n] for n in names) for m in members], ", ".join(names))
    rows = rows.withColumn("id", F.coalesce(F.col("id").cast("bigint"), S.outlet_key(F.col("domain_name"))))
    return outlets.unionByName(S.conform(rows, S.OUTLET).select(outlets.columns))


def outlet_dimension(spark: SparkSession, staged: DataFrame, edit_time: dt.datetime | None = None,
                     members: Iterable[Mapping] = ()) -> DataFrame:
    """Staged outlets with names resolved to ids, plus the unspecified and given members.

    The lookup joins are inner: an outlet whose type, state or bias has no member
    is left out (``audit.lost_in_lookup`` reports those).  A domain listed twice
    keeps its first name, so that a story never matches two outlets.
    """
    resolved = resolve_names(
        staged.filter(F.col("name") != S.UNSPECIFIED),
        {
            "media_outlet_type": (media_types(spark), "media_outlet_type_id"),
            "state": (states(spark), "state_id"),
            "bias": (bias_ratings(spark), "bias_rating_id"),
        },
    )
    one_per_domain = distinct_on(resolved, ["domain_name"], [F.col("name")])
    loaded = one_per_domain.select(
        S.outlet_key(F.col("domain_name")).alias("id"), "name", "domain_name",
        "media_outlet_type_id", "state_id", "bias_rating_id",
        F.lit("").alias("note"), "active",
    )
    stamp = dates.run_timestamp(edit_time)
    full = add_members(spark, S.conform(loaded, S.OUTLET), [UNSPECIFIED_OUTLET, *members])
    return full.withColumn("edit_time", stamp)
