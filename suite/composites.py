"""What a user calls: views, export, dashboard, audits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from coverlens import schemas as S
from coverlens.operators import audit
from coverlens.plans import dashboard as board
from coverlens.plans import stages, story
from coverlens.session import work_path
from coverlens.sources import snapshots
from suite import star
from suite.aggregates import crossfilter_sql
from suite.registry import query, table
from suite.sources_sinks import EXPORT_SQL


@query("view_populate_story", star.story_sql("SELECT * FROM staged"))
def view_populate_story(spark, sf):
    return story.staged_stories(star.feed(spark, sf), star.articles(spark, sf), star.sentences(spark, sf),
                                star.outlets(spark, sf))


@query("view_story_table", star.story_sql("SELECT * FROM story"))
def view_story_table(spark, sf):
    return star.stories(spark, sf)


@query("view_media_outlet", star.with_sql(f"""
SELECT id, {star.SQL_TS} AS edit_time, name, domain_name, media_outlet_type, feed_code, state, state_code, is_state,
       bias_rating, note, active FROM outlet_view""",
    star.SQL_DIMS, star.SQL_FEED, star.SQL_ARTICLE, star.SQL_OUTLET, star.SQL_STORY, star.SQL_WEB))
def view_media_outlet(spark, sf):
    return story.outlet_view(star.outlets(spark, sf))


@query("view_story_web", star.web_sql("SELECT * FROM web"))
def view_story_web(spark, sf):
    return star.web_view(spark, sf)


@query("export_stories", EXPORT_SQL)
def export_stories(spark, sf):
    known = star.outlets(spark, sf)
    return story.export_view(star.stories(spark, sf, known), known)


@query("view_sql", star.web_sql("""
SELECT m.media_outlet_type, w.state, count(*) AS n_stories, count(DISTINCT w.media_outlet) AS n_outlets, max(w.publish_date) AS newest
FROM web w JOIN outlet_view m ON m.name = w.media_outlet WHERE w.media_outlet <> 'Unspecified' GROUP BY ALL"""))
def view_sql(spark, sf):
    known = star.outlets(spark, sf)
    feed, articles, sentences = star.feed(spark, sf), star.articles(spark, sf), star.sentences(spark, sf)
    story.register_views(feed, articles, sentences, known, star.stories(spark, sf, known))
    return spark.sql("""
        SELECT m.media_outlet_type, w.state, count(*) AS n_stories, count(DISTINCT w.media_outlet) AS n_outlets,
               max(w.publish_date) AS newest
        FROM stories_shown w JOIN outlets_named m ON m.name = w.media_outlet
        WHERE w.media_outlet <> 'Unspecified' GROUP BY m.media_outlet_type, w.state""")


BOARD_SELECTIONS = {"bias_rating": ["Center", "Left"], "media_outlet_type": ["Blog", "Other", "Web Publication"]}
BOARD_MASKS = {"bias_rating": "bias_rating IN ('Center', 'Left')",
               "media_outlet_type": "media_outlet_type IN ('Blog', 'Other', 'Web Publication')"}
DIMS = list(board.FACETS)


def board_sql(extra: str = "true") -> str:
    """Ranked facets and the total, one GROUP BY per facet."""
    masks = {**BOARD_MASKS, "_extra": extra}
    tops = " ".join(f"WHEN '{d}' THEN {n}" for d, (_, n) in board.FACETS.items())
    return f"""
SELECT * FROM (SELECT dim, key, n, (row_number() OVER (PARTITION BY dim ORDER BY n DESC, key))::INTEGER AS rank
  FROM ({crossfilter_sql('web', masks, DIMS)} UNION ALL
        SELECT 'total', '', count(*) FILTER (WHERE {' AND '.join(masks.values())}) FROM web))
WHERE rank <= CASE dim {tops} ELSE 1 END"""


SQL_BOARD = board_sql()


def newest_sql(extra: str = "true") -> str:
    return f"""SELECT * FROM web WHERE {' AND '.join(BOARD_MASKS.values())} AND {extra}
    ORDER BY publish_date DESC, id LIMIT 60"""


SQL_NEWEST = newest_sql()


def whole_board_sql(extra: str = "true") -> str:
    return star.web_sql(f"""
SELECT 'facet' AS part, dim, key, n, rank FROM ({board_sql(extra)})
UNION ALL SELECT 'story', media_outlet, id, strftime(publish_date, '%Y%m%d')::BIGINT, 0 FROM ({newest_sql(extra)})""")


def whole_board(shown):
    day = F.date_format("publish_date", "yyyyMMdd").cast("bigint")
    return shown.facets.select(F.lit("facet").alias("part"), "dim", "key", "n", "rank").unionByName(
        shown.newest.select(F.lit("story").alias("part"), F.col("media_outlet").alias("dim"),
                            F.col("id").alias("key"), day.alias("n"), F.lit(0).alias("rank")))


@query("dashboard", whole_board_sql())
def dashboard(spark, sf):
    return whole_board(board.dashboard(star.written_view(spark, sf), BOARD_SELECTIONS))


def grown_fact(spark, sf, root, after=lambda: None):
    """The story fact in three batches: some stories first come with another text, one URL in seven only with the last."""
    S.conform(star.stories(spark, sf), S.STORY).write.parquet(f"{root}/stories")  # made once, taken in three times
    stories = spark.read.schema(S.STORY).parquet(f"{root}/stories")
    late, changed = F.pmod(F.xxhash64("url"), F.lit(7)) == 0, F.pmod(F.xxhash64("url"), F.lit(5)) == 0
    first = stories.filter(~late).withColumns({
        "body": F.when(changed, "").otherwise(F.col("body")),
        "media_outlet_id": F.when(changed, S.DEFAULT_ID).otherwise(F.col("media_outlet_id"))})
    for rows in (first, stories.filter(~late & changed), stories):
        snapshots.merge(rows, f"{root}/story", S.STORY, "url", ["publish_date", "feed_id"], "feed_id", ignore=["edit_time"])
        after()


@query("sink_snapshot_merge", star.story_sql("SELECT * FROM story"))
def sink_snapshot_merge(spark, sf):
    root = work_path(spark, "grown")
    grown_fact(spark, sf, root)
    snapshots.expire(spark, f"{root}/story", 1)
    return stages.stories(spark, root)


@query("dashboard_state", whole_board_sql())
def dashboard_state(spark, sf):
    """The dashboard from facet counts that followed the fact through its batches."""
    root, outlets = work_path(spark, "grown"), star.outlets(spark, sf)
    grown_fact(spark, sf, root, lambda: stages.facet_counts(spark, outlets, root))
    counted = stages.facet_counts(spark, outlets, root)
    return whole_board(board.dashboard_of_state(counted, story.web_view(stages.stories(spark, root), outlets), BOARD_SELECTIONS))


@query("dashboard_filtered", whole_board_sql(
    "publish_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND contains(lower(title || ' ' || sentence), 'returned')"))
def dashboard_filtered(spark, sf):
    extra = board.between(dt.date(1996, 1, 1), dt.date(1999, 12, 31)) & board.mentions("returned")
    return whole_board(board.dashboard(star.written_view(spark, sf), BOARD_SELECTIONS, extra=extra))


# --- audits --------------------------------------------------------------------------

@query("dq_unique", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dq_unique(spark, sf):
    return audit.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_not_null", star.story_sql("""
SELECT 'publish_date' AS column_name, count(*) FILTER (WHERE publish_date IS NULL) AS n_null, count(*) AS n_rows FROM feed
UNION ALL SELECT 'language', count(*) FILTER (WHERE language IS NULL), count(*) FROM feed
UNION ALL SELECT 'url', count(*) FILTER (WHERE url IS NULL), count(*) FROM feed"""))
def dq_not_null(spark, sf):
    return audit.nulls(star.feed(spark, sf), ["publish_date", "language", "url"])


@query("dq_foreign_key", """
SELECT 'order of a known customer' AS check_name, count(DISTINCT o_custkey) AS n_values, count(*) AS n_rows
FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
UNION ALL SELECT 'line of a known supplier', count(DISTINCT l_suppkey), count(*)
FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'line of an order', count(DISTINCT l_orderkey), count(*)
FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def dq_foreign_key(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return audit.foreign_keys([
        ("order of a known customer", o, "o_custkey", table(spark, sf, "customer").filter("c_acctbal >= 0"), "c_custkey"),
        ("line of a known supplier", li, "l_suppkey", table(spark, sf, "supplier"), "s_suppkey"),
        ("line of an order", li, "l_orderkey", o.filter("o_orderstatus <> 'P'"), "o_orderkey"),
    ])


@query("dq_lost_in_lookup", star.outlet_sql("""
SELECT o.name, domain_name, media_outlet_type, state, bias, 'media_outlet_type' AS reason FROM staged_outlet o
WHERE media_outlet_type NOT IN (SELECT name FROM type_dim)"""))
def dq_lost_in_lookup(spark, sf):
    return audit.lost_in_lookup(star.staged_outlets(spark, sf))


@query("dq_unmatched_outlets", star.with_sql("""
SELECT media_url AS domain_name, count(*) AS n_stories FROM feed
WHERE media_url NOT IN (SELECT domain_name FROM outlet) GROUP BY 1""", star.SQL_DIMS, star.SQL_FEED, star.SQL_OUTLET))
def dq_unmatched_outlets(spark, sf):
    return audit.unmatched_domains(star.feed(spark, sf), star.outlets(spark, sf))
