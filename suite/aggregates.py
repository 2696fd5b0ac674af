"""Aggregations, dedup, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverlens.operators import dedup, facet_state, facets
from coverlens.session import work_path
from coverlens.sources import landing
from suite import star
from suite.registry import query, table
from suite.rows import SELECTIONS, event_rows

EVENT_MASKS = {
    "event_type": "event_type IN ('click', 'view')",
    "hour": "hour IN (8, 9, 10, 11, 12)",
    "user_id": "user_id IN (1, 2, 3, 4, 5, 6, 7, 8, 9)",
}
EVENT_SELECTIONS = {**SELECTIONS, "user_id": list(range(1, 10))}
EVENT_DIMS = list(EVENT_MASKS)


def crossfilter_sql(source: str, masks: dict[str, str], dims_: list[str]) -> str:
    """One GROUP BY per dimension over the whole table, with all other masks."""
    parts = []
    for d in dims_:
        others = " AND ".join([m for k, m in masks.items() if k != d]) or "true"
        parts.append(f"SELECT '{d}' AS dim, {d}::VARCHAR AS key, count(*) FILTER (WHERE {others}) AS n "
                     f"FROM {source} GROUP BY {d}")
    return " UNION ALL ".join(parts)


EVENTS_SQL = "(SELECT event_type, hour(ts) AS hour, user_id FROM events)"
EVENT_FACETS_SQL = crossfilter_sql(EVENTS_SQL, EVENT_MASKS, EVENT_DIMS)


@query("agg_high_watermark", star.with_sql("SELECT max(publish_date::DATE) AS max_date FROM feed", star.SQL_FEED))
def agg_high_watermark(spark, sf):
    return landing.high_watermark(star.feed(spark, sf))


@query("agg_count", star.story_sql(
    "SELECT (SELECT count(*) FROM story) AS n_stories, (SELECT count(*) FROM staged_outlet) AS n_outlets"))
def agg_count(spark, sf):
    # the story count needs one row per URL with an article, not the star joins
    n_outlets = star.staged_outlets(spark, sf).agg(F.count("*").alias("n"))
    n_stories = star.stories(spark, sf).agg(F.count("*").alias("n"))
    both = (n_stories.withColumn("what", F.lit("n_stories"))
            .unionByName(n_outlets.withColumn("what", F.lit("n_outlets"))))
    return both.agg(*[F.max(F.when(F.col("what") == w, F.col("n"))).alias(w) for w in ("n_stories", "n_outlets")])


@query("agg_filtered_total", f"SELECT count(*) AS n FROM {EVENTS_SQL} WHERE {' AND '.join(EVENT_MASKS.values())}")
def agg_filtered_total(spark, sf):
    return facets.total(event_rows(spark, sf), EVENT_SELECTIONS)


@query("agg_facet_sum", "SELECT o_orderpriority AS key, count(*) AS n FROM orders GROUP BY 1")
def agg_facet_sum(spark, sf):
    return facets.facet_sum(table(spark, sf, "orders"), "o_orderpriority")


@query("agg_crossfilter", EVENT_FACETS_SQL)
def agg_crossfilter(spark, sf):
    return facets.crossfilter(event_rows(spark, sf), EVENT_DIMS, EVENT_SELECTIONS, tuples_first=False)


@query("agg_facet_state", EVENT_FACETS_SQL)
def agg_facet_state(spark, sf):
    """The facets from counts of three changes; the second one takes back what the first got wrong."""
    rows, path = event_rows(spark, sf), work_path(spark, "facet-state")
    wrong = F.when(F.col("event_id") % 9 == 0, F.lit("misread")).otherwise(F.col("event_type")).alias("event_type")
    first, second = rows.filter("event_id % 3 = 0"), rows.filter("event_id % 3 = 1")
    facet_state.add(first.select(wrong, "hour", "user_id"), None, path, "1")
    misread = first.filter("event_id % 9 = 0")
    facet_state.add(second.unionByName(misread).select(*EVENT_DIMS), misread.select(F.lit("misread").alias("event_type"), "hour", "user_id"), path, "2")
    facet_state.add(rows.filter("event_id % 3 = 2").select(*EVENT_DIMS), None, path, "3")
    state = facet_state.read(spark, path, rows.select(*EVENT_DIMS).schema)
    return facets.crossfilter(state, EVENT_DIMS, EVENT_SELECTIONS, weight=facet_state.COUNT)


KEY_CAPS = {"event_type": 3, "hour": 100, "user_id": 160}


@query("agg_distinct_keys", """
SELECT dim, n_keys, least(n_keys, CASE dim WHEN 'event_type' THEN 3 WHEN 'hour' THEN 100 ELSE 160 END) AS n_bars
FROM (SELECT 'event_type' AS dim, count(DISTINCT event_type) AS n_keys FROM events
      UNION ALL SELECT 'hour', count(DISTINCT hour(ts)) FROM events
      UNION ALL SELECT 'user_id', count(DISTINCT user_id) FROM events)""")
def agg_distinct_keys(spark, sf):
    counts = facets.crossfilter(event_rows(spark, sf), EVENT_DIMS, {}, tuples_first=False)
    return facets.distinct_keys(counts, KEY_CAPS)


@query("agg_distinct_on", "SELECT DISTINCT ON (text) doc_id, text, lang, source FROM documents ORDER BY text, n_chars, doc_id")
def agg_distinct_on(spark, sf):
    docs = table(spark, sf, "documents")
    return dedup.distinct_on_wide(docs, F.col("text"), ["n_chars", "doc_id"], "doc_id").select(
        "doc_id", "text", "lang", "source")


@query("agg_first_per_group", "SELECT source, first(lang ORDER BY doc_id) AS first_value FROM documents GROUP BY source")
def agg_first_per_group(spark, sf):
    return dedup.first_per_group(table(spark, sf, "documents"), "source", F.col("lang"), F.col("doc_id"))


@query("agg_nested_groups", "SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source")
def agg_nested_groups(spark, sf):
    return facets.nested_groups(table(spark, sf, "documents"), ["lang", "source"])


@query("agg_nested_tree", """
WITH leaf AS (SELECT lang, source, n_chars % 3 AS third, count(*) AS n, list(doc_id ORDER BY n_chars DESC, doc_id)[:2] AS members FROM documents GROUP BY ALL),
mid AS (SELECT lang, source, sum(n) AS n, string_agg('/' || third || '=' || n || '(' || array_to_string(members, ' ') || ')', '' ORDER BY third) AS children
        FROM leaf GROUP BY ALL)
SELECT lang, sum(n)::BIGINT AS n, string_agg(source || '=' || n || children, ';' ORDER BY source) AS tree FROM mid GROUP BY lang""")
def agg_nested_tree(spark, sf):
    docs = table(spark, sf, "documents").withColumn("third", F.col("n_chars") % 3)
    tree = facets.nested_tree(docs, ["lang", "source", "third"], ["doc_id", "n_chars"], [F.desc("n_chars"), F.asc("doc_id")], 2)
    ids = lambda members: F.array_join(F.transform(members, lambda m: m["doc_id"].cast("string")), " ")
    third = lambda t: F.concat(F.lit("/"), t["third"].cast("string"), F.lit("="), t["n"].cast("string"), F.lit("("), ids(t["members"]), F.lit(")"))
    source = lambda s: F.concat(s["source"], F.lit("="), s["n"].cast("string"), F.array_join(F.transform(s["children"], third), ""))
    return tree.select("lang", "n", F.array_join(F.transform("children", source), ";").alias("tree"))


@query("agg_outcome_rate", """
SELECT event_type, count(*) FILTER (WHERE value > 10) AS n_ok, count(*) FILTER (WHERE value <= 10) AS n_failed,
       count(*) FILTER (WHERE value > 10) * 100.0::DOUBLE / count(*) AS pct_ok FROM events GROUP BY event_type""")
def agg_outcome_rate(spark, sf):
    return facets.outcome_rate(table(spark, sf, "events"), F.col("value") > 10, "event_type")


@query("sort_recent", star.web_sql("SELECT id, publish_date, media_outlet FROM web ORDER BY publish_date DESC, id"))
def sort_recent(spark, sf):
    return (star.web_view(spark, sf).select("id", "publish_date", "media_outlet")
            .orderBy(F.desc("publish_date"), "id"))


@query("topk_recent", """
SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus IN ('F', 'O')
ORDER BY o_orderdate DESC, o_orderkey LIMIT 60""")
def topk_recent(spark, sf):
    return facets.newest(table(spark, sf, "orders"), {"o_orderstatus": ["F", "O"]}, "o_orderdate", "o_orderkey"
                         ).select("o_orderkey", "o_orderdate", "o_orderpriority")


@query("topk_facet", "SELECT user_id::VARCHAR AS key, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, key LIMIT 9")
def topk_facet(spark, sf):
    counts = facets.facet_sum(table(spark, sf, "events").withColumn("user_id", F.col("user_id").cast("string")), "user_id")
    return facets.top_facet(counts, 9)


TOPS = {"event_type": 3, "hour": 6, "user_id": 160}


@query("topk_per_facet", f"""
SELECT * FROM (
  SELECT dim, key, n, (row_number() OVER (PARTITION BY dim ORDER BY n DESC, key))::INTEGER AS rank
  FROM ({EVENT_FACETS_SQL}))
WHERE rank <= CASE dim WHEN 'event_type' THEN 3 WHEN 'hour' THEN 6 ELSE 160 END""")
def topk_per_facet(spark, sf):
    counts = facets.crossfilter(event_rows(spark, sf), EVENT_DIMS, EVENT_SELECTIONS, tuples_first=False)
    return facets.top_per_facet(counts, TOPS)


@query("set_union_all", """
SELECT doc_id, lang, source FROM documents WHERE lang = 'en' UNION ALL
SELECT doc_id, lang, source FROM documents WHERE lang <> 'en' UNION ALL SELECT doc_id, lang, source FROM documents""")
def set_union_all(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    pages = [docs.filter(F.col("lang") == "en"), docs.filter(F.col("lang") != "en"), docs]
    return pages[0].unionByName(pages[1]).unionByName(pages[2])


@query("set_member_rows", star.outlet_sql("""
SELECT id, name, domain_name, media_outlet_type_id, state_id, bias_rating_id, note, active FROM outlet"""))
def set_member_rows(spark, sf):
    return star.outlets(spark, sf).drop("edit_time")
