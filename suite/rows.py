"""Projections, predicates and NULL rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverlens.functions import display, text
from coverlens.operators import facets
from coverlens.plans import story
from suite import star
from suite.registry import query, table


@query("proj_rename", star.with_sql(
    "SELECT story_id AS id, top_image AS image, text AS body, summary FROM article", star.SQL_ARTICLE))
def proj_rename(spark, sf):
    return star.articles(spark, sf).select(F.col("story_id").alias("id"), F.col("top_image").alias("image"),
                                           F.col("text").alias("body"), "summary")


@query("proj_camel_headers", """
SELECT o_orderkey AS "oOrderkey", o_custkey AS "oCustkey", o_orderstatus AS "oOrderstatus", o_totalprice AS "oTotalprice",
       o_orderdate AS "oOrderdate", o_orderpriority AS "oOrderpriority" FROM orders""")
def proj_camel_headers(spark, sf):
    return story.camel_headers(table(spark, sf, "orders"))


@query("proj_literal", "SELECT o_orderkey, 1 AS syndicator_id, true AS active, 1 AS count FROM orders")
def proj_literal(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.lit(1).alias("syndicator_id"),
                                             F.lit(True).alias("active"), F.lit(1).alias("count"))


@query("null_default", star.with_sql(
    "SELECT f.id, coalesce(x.sentence, '') AS sentence FROM feed f LEFT JOIN sentence x ON x.story_id = f.id",
    star.SQL_FEED, star.SQL_ARTICLE))
def null_default(spark, sf):
    sentence = star.sentences(spark, sf).select(F.col("story_id").alias("id"), "sentence")
    return star.feed(spark, sf).select("id").join(sentence, "id", "left").select(
        "id", F.coalesce("sentence", F.lit("")).alias("sentence"))


@query("null_relabel", """
SELECT c_custkey, coalesce(nullif(n_name, 'NATION_0'), 'National') AS state
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def null_relabel(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    named = n.select("n_nationkey", F.when(F.col("n_name") == "NATION_0", "Unspecified")
                     .otherwise(F.col("n_name")).alias("state"))
    return c.join(named, c.c_nationkey == named.n_nationkey).select(
        "c_custkey", story.national(F.col("state")).alias("state"))


@query("null_empty_coerce", """
SELECT event_id, trim(coalesce(CASE WHEN event_type <> 'error' THEN '  ' || event_type || ' ' END, '')) AS title,
       coalesce(CASE WHEN event_type <> 'view' THEN value > 10 END, false) AS success FROM events""")
def null_empty_coerce(spark, sf):
    e = table(spark, sf, "events")
    title = F.when(F.col("event_type") != "error", F.concat(F.lit("  "), "event_type", F.lit(" ")))
    success = F.when(F.col("event_type") != "view", F.col("value") > 10)
    return e.select("event_id", text.strip(F.coalesce(title, F.lit(""))).alias("title"),
                    F.coalesce(success, F.lit(False)).alias("success"))


@query("title_default", star.with_sql(
    "SELECT id, CASE WHEN title = '' THEN 'Link to story' ELSE title END AS title FROM feed", star.SQL_FEED))
def title_default(spark, sf):
    return star.feed(spark, sf).select("id", display.title_or_default(F.col("title")).alias("title"))


@query("filter_not_equal", "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name <> 'NATION_0'")
def filter_not_equal(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    return (c.join(n, c.c_nationkey == n.n_nationkey).filter(F.col("n_name") != "NATION_0")
            .select("c_custkey", "n_name"))


@query("filter_active", """
SELECT o_orderkey, c_custkey FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus <> 'P' AND c_acctbal >= 0""")
def filter_active(spark, sf):
    facts = table(spark, sf, "orders").withColumn("active", F.col("o_orderstatus") != "P").filter("active")
    dim = table(spark, sf, "customer").withColumn("active", F.col("c_acctbal") >= 0).filter("active")
    return facts.join(dim, facts.o_custkey == dim.c_custkey).select("o_orderkey", "c_custkey")


@query("filter_nonempty", star.with_sql("SELECT story_id, text FROM article WHERE text <> ''", star.SQL_ARTICLE))
def filter_nonempty(spark, sf):
    return star.articles(spark, sf).filter(F.col("text") != "").select("story_id", "text")


@query("filter_like", star.with_sql("""
SELECT story_id, authors LIKE '.Wp-%' AS is_junk, authors LIKE '%, .Wp-%' AS has_junk FROM article
WHERE authors LIKE '.Wp-%' OR authors LIKE '%, .Wp-%'""", star.SQL_ARTICLE))
def filter_like(spark, sf):
    junk, tail = F.col("authors").like(".Wp-%"), F.col("authors").like("%, .Wp-%")
    return star.articles(spark, sf).filter(junk | tail).select("story_id", junk.alias("is_junk"), tail.alias("has_junk"))


@query("filter_keyword", """
SELECT doc_id, lang FROM documents WHERE contains(lower(replace(text, '.', '')), 'thereat')""")
def filter_keyword(spark, sf):
    return (table(spark, sf, "documents").filter(text.mentions(F.col("text"), "ThereAt")).select("doc_id", "lang"))


SELECTIONS = {"event_type": ["click", "view"], "hour": [8, 9, 10, 11, 12]}


def event_rows(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", "event_type", F.hour("ts").alias("hour"), "user_id", "value")


@query("filter_selection", """
SELECT event_id, event_type, hour(ts)::INTEGER AS hour, user_id FROM events
WHERE event_type IN ('click', 'view') AND hour(ts) IN (8, 9, 10, 11, 12)""")
def filter_selection(spark, sf):
    return facets.filter_selected(event_rows(spark, sf), SELECTIONS).drop("value")
