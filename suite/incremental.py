"""Incremental landing, streams and the staged run."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens.functions import html
from coverlens.operators import lookup
from coverlens.plans import stages
from coverlens.session import work_path
from coverlens.sources import dims, landing, writers
from coverlens.streaming import incremental
from suite import star
from suite.registry import query, table
from suite.sources_sinks import FIRST_LANGS
from suite.texts import KEYWORD, SQL_BODY, SQL_SUMMARY, sql_mentions, sql_sentences, sql_strip, STRAIGHT


@query("inc_high_watermark", star.with_sql("""
SELECT id, publish_date FROM feed
WHERE publish_date::DATE >= (SELECT max(publish_date::DATE) FROM feed WHERE publish_date <= '1998-06-30')
  AND publish_date::DATE <= DATE '2000-12-31' AND NOT publish_date <= '1998-06-30'""", star.SQL_FEED))
def inc_high_watermark(spark, sf):
    feed = star.feed(spark, sf)
    stored = feed.filter(F.col("publish_date") <= "1998-06-30")
    fetched = landing.in_window(feed, *landing.next_window(stored, dt.date(2000, 12, 31)))
    return lookup.only_new(fetched, stored, "id").select("id", "publish_date")


@query("inc_stream_append", "SELECT doc_id, text, lang, source FROM documents")
def inc_stream_append(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    root = work_path(spark, "stream-append")

    def deliver_and_land(rows):
        rows.write.mode("append").parquet(f"{root}/landing")
        stream = incremental.stream_files(spark, f"{root}/landing", docs.schema)
        incremental.stream_append(stream, f"{root}/target", f"{root}/checkpoint", docs.schema, "doc_id").awaitTermination()

    deliver_and_land(docs.filter(F.col("lang").isin(FIRST_LANGS)))
    deliver_and_land(docs)  # overlaps the first delivery; the stream resumes from its checkpoint
    return spark.read.parquet(f"{root}/target").drop("batch")


@query("inc_bounded_dedup", "SELECT event_id, ts, event_type FROM events")
def inc_bounded_dedup(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "event_type")
    # a watermark needs an instant; the zone-less time itself is carried along unchanged
    timed = events.withColumn("at", F.col("ts").cast("timestamp"))
    root = work_path(spark, "stream-dedup")
    # the second delivery repeats the first and brings events that are weeks late
    for delivery in (timed.filter("event_id % 10 <> 0"), timed):
        delivery.unionByName(delivery).write.mode("append").parquet(f"{root}/landing")
        stream = incremental.stream_files(spark, f"{root}/landing", timed.schema)
        kept = incremental.bounded_dedup(stream, "event_id", "at", "1 hour")
        incremental.stream_table(kept, f"{root}/target", f"{root}/checkpoint").awaitTermination()
    incremental.append_late(spark, spark.read.schema(timed.schema).parquet(f"{root}/landing"), f"{root}/target", "event_id")
    return incremental.read_all(spark, f"{root}/target", timed.schema).drop("at")


@query("inc_stage_backlog", star.with_sql("""
SELECT 'article' AS stage, id FROM feed WHERE id NOT IN (SELECT story_id FROM article)
UNION ALL SELECT 'article with retries', id FROM feed WHERE id NOT IN (SELECT story_id FROM article WHERE success)
UNION ALL SELECT 'sentence', story_id FROM article WHERE text <> '' AND story_id NOT IN (SELECT story_id FROM sentence)""",
    star.SQL_FEED, star.SQL_ARTICLE))
def inc_stage_backlog(spark, sf):
    feed, articles = star.feed(spark, sf), star.articles(spark, sf)
    todo = stages.article_backlog(feed, articles).select(F.lit("article").alias("stage"), "id")
    retry = stages.article_backlog(feed, articles, retry_failed=True).select(F.lit("article with retries").alias("stage"), "id")
    sentence = stages.sentence_backlog(articles, star.sentences(spark, sf)).select(
        F.lit("sentence").alias("stage"), F.col("story_id").alias("id"))
    return todo.unionByName(retry).unionByName(sentence)


# --- the staged run over the pages table ----------------------------------------------

UNDATED = 90  # one page in so many has a date that does not parse and is rejected


def page_feed(spark, sf):
    key = F.col("page_id").cast("string")
    return table(spark, sf, "pages").select(
        key.alias("id"),
        F.when(F.col("page_id") % UNDATED == 7, "soon").otherwise(
            F.concat(F.lit("2024-03-"), F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0"))).alias("publish_date"),
        F.concat(F.lit("Story "), key).alias("title"), "url", F.lit("en").alias("language"),
        html.page_domain(F.col("url"), keep_www=True).alias("media_url"))


def page_outlets(spark, sf):
    hosts = (page_feed(spark, sf).select(F.col("media_url").alias("domain_name")).distinct()
             .filter(~F.startswith("domain_name", F.lit("m."))))
    ends = lambda suffix: F.endswith("domain_name", F.lit(suffix))
    staged = hosts.select(
        F.concat(F.lit("The "), "domain_name").alias("name"), "domain_name",
        F.when(F.startswith("domain_name", F.lit("blog.")), "Blog").otherwise("Web Publication").alias("media_outlet_type"),
        F.when(ends(".org"), "Unspecified").when(ends(".net"), "Texas").otherwise("Ohio").alias("state"),
        F.when(F.startswith("domain_name", F.lit("www.")), "Left").otherwise("Center").alias("bias"),
        F.lit(True).alias("active"))
    return dims.outlet_dimension(spark, staged, star.RUN_TS)


MONTH = (dt.date(2024, 3, 1), dt.date(2024, 3, 31))
MID_MONTH = dt.date(2024, 3, 14)


def staged_runs(spark, sf, pulls):
    """The five stages once per (batch, start, today); the table root and all metrics."""
    root = work_path(spark, "staged-run")
    feed = page_feed(spark, sf)
    outlets = writers.full_refresh(page_outlets(spark, sf), f"{root}/outlet", "v1")
    pages = landing.read_pages(spark, f"{sf}/pages.parquet")
    metrics = [stages.run_stages(spark, root, feed, pages, outlets, KEYWORD, batch, today, start, star.RUN_TS)
               for batch, start, today in pulls]
    return root, reduce(DataFrame.unionByName, metrics)


SQL_PAGE_FEED = f"""
pfeed AS (SELECT page_id, md5(url) AS id, DATE '2024-03-01' + (page_id % 28)::INTEGER AS publish_date, 'Story ' || page_id AS title, url,
  lower(split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1)) AS host FROM pages WHERE page_id % {UNDATED} <> 7)"""
SQL_PAGE_HITS = (f"SELECT page_id, first(s ORDER BY length(s) DESC, i) AS s FROM ({sql_sentences(f'({SQL_BODY})', 'page_id', 'body')}) "
                 f"WHERE {sql_mentions('s', KEYWORD)} GROUP BY page_id")
SQL_PAGE_STORY = f"""
pstory AS (SELECT f.*, b.body, coalesce(l.summary, '') AS summary, {sql_strip(STRAIGHT.format("coalesce(h.s, '')"))} AS sentence
  FROM pfeed f JOIN ({SQL_BODY}) b USING (page_id) LEFT JOIN ({SQL_SUMMARY}) l USING (page_id) LEFT JOIN ({SQL_PAGE_HITS}) h USING (page_id))"""


SQL_EXPORTED = star.with_sql("""
SELECT id, publish_date AS "publishDate", title, url, '' AS authors, '' AS image, summary, 'en' AS language, 'The ' || host AS "mediaOutlet",
  CASE WHEN starts_with(host, 'blog.') THEN 'Blog' ELSE 'Web Publication' END AS "mediaOutletType",
  CASE WHEN host LIKE '%.org' THEN 'National' WHEN host LIKE '%.net' THEN 'Texas' ELSE 'Ohio' END AS state,
  CASE WHEN host LIKE '%.org' THEN '' WHEN host LIKE '%.net' THEN 'TX' ELSE 'OH' END AS "stateCode",
  CASE WHEN starts_with(host, 'www.') THEN 'Left' ELSE 'Center' END AS "biasRating", sentence, 'None' AS syndicator
FROM (SELECT DISTINCT ON (url) * FROM pstory ORDER BY url, publish_date, page_id::VARCHAR) WHERE NOT starts_with(host, 'm.')""",
    SQL_PAGE_FEED, SQL_PAGE_STORY)


@query("five_stage_run", SQL_EXPORTED)
def five_stage_run(spark, sf):
    root, _ = staged_runs(spark, sf, [("r1", *MONTH)])
    return spark.read.parquet(f"{root}/export/r1/parquet")


@query("five_stage_second_run", SQL_EXPORTED)
def five_stage_second_run(spark, sf):
    """The export after a second batch that the fact took in."""
    root, _ = staged_runs(spark, sf, [("r1", MONTH[0], MID_MONTH), ("r2", None, MONTH[1])])
    return spark.read.parquet(f"{root}/export/r2/parquet")


def _metrics_sql() -> str:
    """One row per batch and metric; the second pull starts on the first one's last day."""
    parts = []
    for batch, fetched, new in (("r1", "day <= 14", "day <= 14"), ("r2", "day >= 14", "day > 14")):
        stored = "day <= 14" if batch == "r1" else "true"
        for stage, metric, value in (
            ("feed", "n_fetched", f"count(*) FILTER (WHERE {fetched}) + any_value(n_undated)"),
            ("feed", "n_rejected", "any_value(n_undated)"),
            ("feed", "n_inserted", f"count(*) FILTER (WHERE {new})"),
            ("feed", "n_skipped", f"count(*) FILTER (WHERE {fetched}) - count(*) FILTER (WHERE {new})"),
            ("article", "n_ok", f"count(*) FILTER (WHERE {new} AND body <> '')"),
            ("article", "n_failed", f"count(*) FILTER (WHERE {new} AND body = '')"),
            ("sentence", "n_checked", f"count(*) FILTER (WHERE {new} AND body <> '')"),
            ("sentence", "n_found", f"count(*) FILTER (WHERE {new} AND sentence <> '')"),
            ("story", "n_stories", f"count(DISTINCT url) FILTER (WHERE {stored})"),
            ("export", "n_exported", f"count(DISTINCT url) FILTER (WHERE {stored} AND NOT starts_with(host, 'm.'))"),
        ):
            parts.append(f"SELECT '{batch}' AS batch, '{stage}' AS stage, '{metric}' AS metric, {value} AS value FROM days")
    return " UNION ALL ".join(parts)


@query("inc_run_metrics", star.with_sql(_metrics_sql(), SQL_PAGE_FEED, SQL_PAGE_STORY,
                                        f"""days AS (SELECT *, day(publish_date) AS day, (SELECT count(*) FROM pages WHERE page_id % {UNDATED} = 7) AS n_undated
                                        FROM pstory)"""))
def inc_run_metrics(spark, sf):
    # a first pull up to mid-month, then one that starts on its last day
    return staged_runs(spark, sf, [("r1", MONTH[0], MID_MONTH), ("r2", None, MONTH[1])])[1]
