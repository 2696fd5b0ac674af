"""The library's tables derived from the TPC-H-like ones, in Spark and in SQL.

orders -> story feed, lineitem -> articles and sentences, customer with nation and
region -> outlets.  Some domains have no outlet, some have a type that no
dimension knows, some are inactive; several orders share a URL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.functions import dates
from coverlens.plans import story
from coverlens.session import work_path
from coverlens.sources import dims
from suite.registry import table

UNLISTED = 13  # the stories of every so manieth customer come from a domain that no outlet has
RUN_TS = dt.datetime(2024, 6, 1, 12, 0, 0)
OWN_SITE = dims.member_row("Own Site", "own-site.example.com", media_outlet_type_id=8, bias_rating_id=4)
SEGMENT_TYPE = {"BUILDING": "Blog", "AUTOMOBILE": "Local News Outlet", "HOUSEHOLD": "National News Outlet",
                "FURNITURE": "Web Publication", "MACHINERY": "Trade Journal"}


def domain(key):
    return F.concat(F.lit("outlet"), key.cast("string"), F.lit(".example.com"))


def feed(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    listed = F.col("o_custkey") % UNLISTED != 0
    site = F.when(listed, domain(F.col("o_custkey"))).otherwise(F.concat(F.lit("un"), domain(F.col("o_custkey"))))
    key = F.col("o_orderkey").cast("string")
    return o.select(
        F.concat(F.lit("s"), key).alias("id"),
        F.when(F.col("o_orderkey") % 97 != 0, F.to_date("o_orderdate").cast("string")).alias("publish_date"),
        F.when(F.col("o_orderkey") % 11 == 0, "")
        .otherwise(F.concat("o_orderpriority", F.lit(" order "), key)).alias("title"),
        F.concat(F.lit("https://"), site, F.lit("/"), F.year("o_orderdate").cast("string"), F.lit("/"),
                 F.lower(F.substring("o_orderpriority", 1, 1))).alias("url"),
        F.when(F.col("o_orderstatus") == "O", "en").when(F.col("o_orderstatus") == "F", "es").alias("language"),
        site.alias("media_url"),
    )


def articles(spark: SparkSession, sf: str) -> DataFrame:
    per_order = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("n"), F.max("l_quantity").alias("q"), F.min("l_shipdate").alias("shipped"),
        F.max("l_returnflag").alias("flag"))
    key = F.col("l_orderkey").cast("string")
    ok = F.col("q") > 10
    byline = (F.when(F.col("l_orderkey") % 4 == 0, ".Wp-block {color}")
              .when(F.col("l_orderkey") % 4 == 1, F.concat(F.lit("Writer "), key, F.lit(", .Wp-block, .Wp-x")))
              .when(F.col("l_orderkey") % 4 == 2, F.concat(F.lit("Writer "), key, F.lit(", Editor"))))
    return per_order.select(
        F.concat(F.lit("s"), key).alias("story_id"),
        dates.run_timestamp(RUN_TS).alias("import_date"),
        F.concat(F.lit("Page "), key).alias("title"),
        F.when(ok, F.concat(F.lit("Shipped "), F.col("n").cast("string"), F.lit(" lines. Flag "), "flag", F.lit(".")))
        .otherwise("").alias("text"),
        F.col("shipped").alias("publish_date"), byline.alias("authors"),
        F.concat(F.lit("https://img.example.com/"), key, F.lit(".png")).alias("top_image"),
        F.concat(F.col("n").cast("string"), F.lit(" lines")).alias("summary"),
        ok.alias("success"), F.when(~ok, "no body text").alias("error"),
    )


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    returned = (table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
                .groupBy("l_orderkey").agg(F.count("*").alias("n")))
    return returned.select(
        F.concat(F.lit("s"), F.col("l_orderkey").cast("string")).alias("story_id"),
        dates.run_timestamp(RUN_TS).alias("import_date"),
        F.concat(F.lit("Returned "), F.col("n").cast("string"), F.lit(" lines")).alias("sentence"))


def staged_outlets(spark: SparkSession, sf: str) -> DataFrame:
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    state = dims.states(spark).select(F.col("id").alias("state_id"), F.col("name").alias("state"))
    bias = dims.bias_ratings(spark).select(F.col("id").alias("bias_id"), F.col("name").alias("bias"))
    kind = F.lit(None).cast("string")
    for segment, name in SEGMENT_TYPE.items():
        kind = F.when(F.col("c_mktsegment") == segment, name).otherwise(kind)
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .join(state, F.col("n_nationkey") + 1 == F.col("state_id"))
            .join(bias, F.col("n_regionkey") + 2 == F.col("bias_id"))
            .select(F.col("c_name").alias("name"), domain(F.col("c_custkey")).alias("domain_name"),
                    kind.alias("media_outlet_type"), "state", "bias", (F.col("c_acctbal") >= 0).alias("active")))


def outlets(spark: SparkSession, sf: str) -> DataFrame:
    return dims.outlet_dimension(spark, staged_outlets(spark, sf), RUN_TS, [OWN_SITE])


def stories(spark: SparkSession, sf: str, known: DataFrame | None = None) -> DataFrame:
    return story.story_table(feed(spark, sf), articles(spark, sf), sentences(spark, sf),
                             known or outlets(spark, sf), RUN_TS)


def web_view(spark: SparkSession, sf: str) -> DataFrame:
    known = outlets(spark, sf)
    return story.web_view(stories(spark, sf, known), known)


def written_view(spark: SparkSession, sf: str) -> DataFrame:
    """The web view as a table: a dashboard reads it several times."""
    path = work_path(spark, "web-view")
    web_view(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


# --- the same in SQL -----------------------------------------------------------------

def values(rows: list[tuple]) -> str:
    cell = lambda v: str(v).lower() if isinstance(v, bool) else repr(v) if isinstance(v, int) else "'" + v + "'"
    return ", ".join("(" + ", ".join(map(cell, row)) + ")" for row in rows)


def sql_md5_key(column: str) -> str:
    return f"('0x' || substr(md5({column}), 1, 15))::BIGINT"


SQL_TS = "TIMESTAMP '2024-06-01 12:00:00'"
_KIND = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENT_TYPE.items())

SQL_DIMS = f"""
state_dim(id, name, code, is_state) AS (VALUES {values(dims.STATES)}),
type_dim(id, name, feed_code) AS (VALUES {values(dims.MEDIA_TYPES)}),
bias_dim(id, name, ordering) AS (VALUES {values(dims.BIAS_RATINGS)}),
syndicator_dim(id, name, code) AS (VALUES {values(dims.SYNDICATORS)})"""

SQL_FEED = f"""
feed AS (
  SELECT 's' || o_orderkey AS id,
         CASE WHEN o_orderkey % 97 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS publish_date,
         CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE o_orderpriority || ' order ' || o_orderkey END AS title,
         'https://' || site || '/' || year(o_orderdate) || '/' || lower(o_orderpriority[1]) AS url,
         CASE o_orderstatus WHEN 'O' THEN 'en' WHEN 'F' THEN 'es' END AS language, site AS media_url
  FROM (SELECT *, if(o_custkey % {UNLISTED} = 0, 'un', '') || 'outlet' || o_custkey || '.example.com' AS site FROM orders))"""

SQL_ARTICLE = f"""
article AS (
  SELECT 's' || l_orderkey AS story_id, 'Page ' || l_orderkey AS title,
         CASE WHEN max(l_quantity) > 10 THEN 'Shipped ' || count(*) || ' lines. Flag ' || max(l_returnflag) || '.' ELSE '' END AS text,
         CASE l_orderkey % 4 WHEN 0 THEN '.Wp-block {{color}}' WHEN 1 THEN 'Writer ' || l_orderkey || ', .Wp-block, .Wp-x'
              WHEN 2 THEN 'Writer ' || l_orderkey || ', Editor' END AS authors,
         'https://img.example.com/' || l_orderkey || '.png' AS top_image,
         count(*) || ' lines' AS summary, max(l_quantity) > 10 AS success
  FROM lineitem GROUP BY l_orderkey),
sentence AS (
  SELECT 's' || l_orderkey AS story_id, 'Returned ' || count(*) || ' lines' AS sentence
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)"""

# Names become ids, and ids names, by maps from the dimensions; a name without a member drops out.
SQL_OUTLET = f"""
codes AS (
  SELECT (SELECT map(list(name), list(id)) FROM type_dim) AS type_of, (SELECT map(list(name), list(id)) FROM state_dim) AS state_of,
         (SELECT map(list(name), list(id)) FROM bias_dim) AS bias_of),
staged_outlet AS (
  SELECT c_name AS name, 'outlet' || c_custkey || '.example.com' AS domain_name, CASE c_mktsegment {_KIND} END AS media_outlet_type,
         (SELECT any_value(name) FROM state_dim WHERE id = n_nationkey + 1) AS state,
         (SELECT any_value(name) FROM bias_dim WHERE id = n_regionkey + 2) AS bias, c_acctbal >= 0 AS active
  FROM nation, customer WHERE n_nationkey = c_nationkey),
outlet AS (
  SELECT {sql_md5_key('domain_name')} AS id, name, domain_name, type_of[media_outlet_type] AS media_outlet_type_id,
         state_of[state] AS state_id, bias_of[bias] AS bias_rating_id, '' AS note, active
  FROM codes, staged_outlet WHERE type_of[media_outlet_type] + state_of[state] + bias_of[bias] IS NOT NULL
  UNION ALL FROM (VALUES (1, 'Unspecified', 'None', 1, 1, 1, '', true),
                         ({sql_md5_key("'own-site.example.com'")}, 'Own Site', 'own-site.example.com', 8, 1, 4, '', true)))"""

# A feed row with what its article, sentence and domain add; then, of each URL, the row that was
# first by day and id, found on the feed alone.
SQL_STORY = f"""
outlet_of AS (SELECT map(list(domain_name), list(id)) AS of_domain FROM outlet),
staged AS (
  SELECT 1 AS syndicator_id, coalesce(of_domain[media_url], 1) AS media_outlet_id, id AS feed_id,
         coalesce(try_cast(publish_date AS DATE), DATE '2000-01-01') AS publish_date, feed.title, url, language,
         regexp_extract(authors, '^(?:\\.Wp-.*|(.*?)(?:, \\.Wp-.*)?)$', 1, 's') AS authors,
         top_image AS image, text AS body, summary, coalesce(sentence, '') AS sentence, success, true AS active
  FROM outlet_of, (SELECT story_id AS id, * EXCLUDE (story_id, title) FROM article) JOIN feed USING (id)
  LEFT JOIN (SELECT story_id AS id, sentence FROM sentence) USING (id)),
story AS (
  SELECT md5(url) AS id, {SQL_TS} AS edit_time, syndicator_id, media_outlet_id, feed_id, url, publish_date, ifnull(title, '') AS title,
         ifnull(language, 'en') AS language, ifnull(authors, '') AS authors, ifnull(image, '') AS image, ifnull(body, '') AS body,
         sentence, ifnull(summary, '') AS summary, active
  FROM staged WHERE feed_id IN (
    SELECT arg_min(id, (coalesce(try_cast(publish_date AS DATE), DATE '2000-01-01'), id)) FROM feed SEMI JOIN article ON story_id = id GROUP BY url))"""

SQL_WEB = """
outlet_view AS (
  SELECT id, name, domain_name, media_outlet_type, feed_code, state, state_code, is_state, bias_rating, note, active
  FROM outlet
  JOIN (SELECT id AS bias_rating_id, name AS bias_rating FROM bias_dim) USING (bias_rating_id)
  JOIN (SELECT id AS state_id, name AS state, code AS state_code, is_state FROM state_dim) USING (state_id)
  JOIN (SELECT id AS media_outlet_type_id, name AS media_outlet_type, feed_code FROM type_dim) USING (media_outlet_type_id)),
web AS (
  SELECT * EXCLUDE (media_outlet_id, syndicator_id) REPLACE (CASE state WHEN 'Unspecified' THEN 'National' ELSE coalesce(state, 'National') END AS state)
  FROM (SELECT id AS media_outlet_id, name AS media_outlet, media_outlet_type, state, state_code, bias_rating FROM outlet_view WHERE active)
  JOIN (SELECT id, publish_date, title, url, authors, image, summary, language, sentence, media_outlet_id, syndicator_id FROM story WHERE active)
    USING (media_outlet_id)
  JOIN (SELECT id AS syndicator_id, name AS syndicator FROM syndicator_dim) USING (syndicator_id))"""


def with_sql(select: str, *parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def outlet_sql(select: str) -> str:
    return with_sql(select, SQL_DIMS, SQL_OUTLET)


def story_sql(select: str) -> str:
    return with_sql(select, SQL_DIMS, SQL_FEED, SQL_ARTICLE, SQL_OUTLET, SQL_STORY)


def web_sql(select: str, *more: str) -> str:
    return with_sql(select, SQL_DIMS, SQL_FEED, SQL_ARTICLE, SQL_OUTLET, SQL_STORY, SQL_WEB, *more)
