"""Joins and work lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverlens.operators import lookup
from coverlens.plans import story
from coverlens.sources import dims
from suite import star
from suite.registry import query, table


@query("join_inner", """
SELECT o_orderkey, l_linenumber, l_quantity, l_shipdate FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def join_inner(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return o.join(li, o.o_orderkey == li.l_orderkey).select("o_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


@query("join_left", """
SELECT d.doc_id, d.lang, coalesce(l.quality, 0) AS quality, coalesce(l.toxic, 0) AS toxic
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def join_left(spark, sf):
    joined = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return joined.select("doc_id", "lang", F.coalesce("quality", F.lit(0)).alias("quality"),
                         F.coalesce("toxic", F.lit(0)).alias("toxic"))


@query("join_left_default", star.with_sql("""
SELECT f.id, coalesce(m.id, 1) AS media_outlet_id FROM feed f LEFT JOIN outlet m ON m.domain_name = f.media_url""",
    star.SQL_DIMS, star.SQL_FEED, star.SQL_OUTLET))
def join_left_default(spark, sf):
    keys = star.outlets(spark, sf).select("domain_name", F.col("id").alias("media_outlet_id"))
    return lookup.lookup_default(star.feed(spark, sf), keys, "media_url", "domain_name", {"media_outlet_id": 1},
                                 ).select("id", "media_outlet_id")


@query("join_star", """
SELECT c_custkey, c_mktsegment, n_name, r_name FROM customer
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def join_star(spark, sf):
    c, n, r = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select("c_custkey", "c_mktsegment", "n_name", "r_name"))


@query("join_natural_key", star.outlet_sql("""
SELECT o.name, t.id AS media_outlet_type_id, s.id AS state_id, b.id AS bias_rating_id
FROM staged_outlet o JOIN type_dim t ON t.name = o.media_outlet_type
JOIN state_dim s ON s.name = o.state JOIN bias_dim b ON b.name = o.bias"""))
def join_natural_key(spark, sf):
    resolved = lookup.resolve_names(star.staged_outlets(spark, sf), {
        "media_outlet_type": (dims.media_types(spark), "media_outlet_type_id"),
        "state": (dims.states(spark), "state_id"),
        "bias": (dims.bias_ratings(spark), "bias_rating_id")})
    return resolved.select("name", "media_outlet_type_id", "state_id", "bias_rating_id")


@query("join_view_on_view", star.web_sql("""
SELECT s.id, m.name AS media_outlet, m.media_outlet_type, m.bias_rating, y.name AS syndicator
FROM story s JOIN outlet_view m ON s.media_outlet_id = m.id JOIN syndicator_dim y ON y.id = s.syndicator_id"""))
def join_view_on_view(spark, sf):
    known = star.outlets(spark, sf)
    outlet = story.outlet_view(known).select(
        F.col("id").alias("media_outlet_id"), F.col("name").alias("media_outlet"), "media_outlet_type", "bias_rating")
    return (story.with_syndicator(star.stories(spark, sf, known)).join(outlet, "media_outlet_id")
            .select("id", "media_outlet", "media_outlet_type", "bias_rating", "syndicator"))


@query("join_anti_not_in", star.with_sql(
    "SELECT id, url FROM feed WHERE id NOT IN (SELECT story_id FROM article)", star.SQL_FEED, star.SQL_ARTICLE))
def join_anti_not_in(spark, sf):
    done = table(spark, sf, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_orderkey").cast("string")).alias("story_id"))
    return lookup.pending(star.feed(spark, sf).select("id", "url"), done, "id", "story_id")


@query("join_anti_filtered", """
SELECT doc_id, text FROM documents WHERE text <> '' AND doc_id NOT IN (SELECT doc_id FROM labels)""")
def join_anti_filtered(spark, sf):
    todo = table(spark, sf, "documents").filter(F.col("text") != "").select("doc_id", "text")
    return lookup.pending(todo, table(spark, sf, "labels"), "doc_id", "doc_id")


@query("join_anti_isin", """
SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def join_anti_isin(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return lookup.only_new(docs, table(spark, sf, "labels"), "doc_id")


@query("join_fk_orphans", """
SELECT l_orderkey, count(*) AS n_rows FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1""")
def join_fk_orphans(spark, sf):
    known = table(spark, sf, "orders").filter(F.col("o_orderstatus") != "P")
    return lookup.orphans(table(spark, sf, "lineitem"), known, "l_orderkey", "o_orderkey")
