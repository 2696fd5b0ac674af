"""Sources and sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from coverlens import schemas as S
from coverlens.functions import text
from coverlens.operators import terms
from coverlens.plans import story
from coverlens.session import work_path
from coverlens.sources import dims, keyindex, landing, paged, writers
from suite import star
from suite.registry import query, table

FIRST_LANGS = ["en", "fr"]  # what the first of two overlapping deliveries holds


@query("src_landing_feed", star.with_sql("""
SELECT id, publish_date, title, url, language, media_url, CASE WHEN publish_date IS NULL THEN 'no publish date' END AS reason FROM feed
WHERE publish_date IS NULL OR publish_date::DATE BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'""", star.SQL_FEED))
def src_landing_feed(spark, sf):
    path = work_path(spark, "landing")
    star.feed(spark, sf).write.json(path)
    taken = landing.read_feed(spark, path, dt.date(1996, 1, 1), dt.date(1998, 12, 31))
    return taken.withColumn("reason", F.lit(None).cast("string")).unionByName(landing.undated(landing.read_feed(spark, path)))


@query("src_paged_feed", star.with_sql("SELECT * FROM feed", star.SQL_FEED))
def src_paged_feed(spark, sf):
    """The feed landed as pages of a chain, read back along the tokens."""
    feed, pages, path = star.feed(spark, sf), 12, work_path(spark, "pages")
    page = F.pmod(F.xxhash64("id"), F.lit(pages)).cast("int")
    token = lambda i: F.when(i == 0, F.lit(paged.FIRST)).otherwise(F.md5(i.cast("string")))
    lines = feed.select(page.alias("i"), F.to_json(F.struct(*feed.columns)).alias("value"), F.lit(1).alias("order"))
    heads = spark.range(pages).select(F.col("id").cast("int").alias("i"), F.to_json(F.struct(
        F.when(F.col("id") < pages - 1, token(F.col("id").cast("int") + 1)).alias("next"))).alias("value"), F.lit(0).alias("order"))
    (heads.unionByName(lines).withColumn("page", token(F.col("i"))).repartition(pages, "page").sortWithinPartitions("page", "order")
     .select("page", "value").write.partitionBy("page").text(path))
    return paged.read_pages(spark, path, S.FEED)


@query("src_term_query", """
SELECT doc_id, lang, source FROM documents
WHERE contains(lower(text), 'there') OR contains(lower(text), 'elle')""")
def src_term_query(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.filter(text.search_terms(F.col("text"), ["There", "elle"])).select("doc_id", "lang", "source")


# Terms: every word of the benchmark's texts, and every two neighbours.
SQL_TERMS = """
SELECT DISTINCT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term
FROM (SELECT list_filter(regexp_split_to_array(lower(text), '[ \\t\\r\\n\\f]+'), lambda x: x <> '') AS w FROM benchmark)"""


def benchmark_terms(spark, sf):
    words = F.filter(F.split(F.lower("text"), r"[ \t\r\n\f]+"), lambda w: w != "")
    pairs = F.transform(F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, F.size("w")).alias("b")),
                        lambda p: F.concat_ws(" ", p["a"], p["b"]))
    return table(spark, sf, "benchmark").select(words.alias("w")).select(F.explode(F.concat("w", pairs)).alias("term"))


@query("src_term_table", f"""
SELECT d.doc_id, t.term FROM documents d JOIN ({SQL_TERMS}) t ON contains(lower(d.text), t.term)""")
def src_term_table(spark, sf):
    return terms.term_hits(table(spark, sf, "documents"), benchmark_terms(spark, sf), "doc_id")


@query("filter_term_table", f"""
SELECT doc_id, lang, source FROM documents WHERE doc_id IN (
  SELECT d.doc_id FROM documents d JOIN ({SQL_TERMS}) t ON contains(lower(d.text), t.term) WHERE contains(t.term, ' ') AND length(t.term) > 12)""")
def filter_term_table(spark, sf):
    phrases = benchmark_terms(spark, sf).filter(F.contains("term", F.lit(" ")) & (F.length("term") > 12))
    return terms.holding_terms(table(spark, sf, "documents"), phrases, "doc_id").select("doc_id", "lang", "source")


@query("src_csv_outlets", star.outlet_sql(
    "SELECT name, domain_name, media_outlet_type, state, bias, active FROM staged_outlet"))
def src_csv_outlets(spark, sf):
    path = work_path(spark, "outlets-csv")
    writers.write_csv(star.staged_outlets(spark, sf), path)
    return dims.read_outlets_csv(spark, path)


@query("src_static_dims", star.outlet_sql("""
SELECT 'state' AS dim, d.id, d.name, count(o.id) AS n_outlets FROM state_dim d LEFT JOIN outlet o ON o.state_id = d.id GROUP BY ALL
UNION ALL SELECT 'media_outlet_type', d.id, d.name, count(o.id) FROM type_dim d LEFT JOIN outlet o ON o.media_outlet_type_id = d.id GROUP BY ALL
UNION ALL SELECT 'bias_rating', d.id, d.name, count(o.id) FROM bias_dim d LEFT JOIN outlet o ON o.bias_rating_id = d.id GROUP BY ALL"""))
def src_static_dims(spark, sf):
    outlets = star.outlets(spark, sf)
    frames = dims.static_dimensions(spark, star.RUN_TS)

    def usage(dim):
        counts = outlets.groupBy(F.col(f"{dim}_id").alias("id")).agg(F.count("*").alias("n"))
        return frames[dim].join(counts, "id", "left").select(
            F.lit(dim).alias("dim"), "id", "name", F.coalesce("n", F.lit(0)).alias("n_outlets"))

    return usage("state").unionByName(usage("media_outlet_type")).unionByName(usage("bias_rating"))


@query("src_table_scan", "SELECT doc_id, text FROM documents")
def src_table_scan(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


@query("src_html_pages", "SELECT page_id::VARCHAR AS id, url, html FROM pages")
def src_html_pages(spark, sf):
    return landing.read_pages(spark, f"{sf}/pages.parquet")


@query("src_csv_gzip", """
SELECT doc_id::VARCHAR AS doc_id, text, lang, source, n_chars::VARCHAR AS n_chars FROM documents""")
def src_csv_gzip(spark, sf):
    docs = table(spark, sf, "documents")
    path = work_path(spark, "documents-csv-gz")
    writers.write_csv_gzip(docs, path)
    return writers.read_csv(spark, path, docs.columns)


EXPORT_SQL = star.web_sql("""
SELECT id, publish_date AS "publishDate", title, url, authors, image, summary, language, media_outlet AS "mediaOutlet",
       media_outlet_type AS "mediaOutletType", state, state_code AS "stateCode", bias_rating AS "biasRating",
       sentence, syndicator
FROM web WHERE media_outlet <> 'Unspecified'""")
EXPORT_STRINGS_SQL = f"""
SELECT * REPLACE (strftime("publishDate", '%Y-%m-%d') AS "publishDate") FROM ({EXPORT_SQL})"""


def _export_frame(spark, sf):
    known = star.outlets(spark, sf)
    return story.export_view(star.stories(spark, sf, known), known)


@query("src_parquet_export", EXPORT_SQL)
def src_parquet_export(spark, sf):
    path = work_path(spark, "export")
    writers.export(_export_frame(spark, sf), path)
    return spark.read.parquet(f"{path}/parquet")


@query("sink_parquet", EXPORT_SQL)
def sink_parquet(spark, sf):
    path = work_path(spark, "sink-parquet")
    writers.write_parquet(_export_frame(spark, sf), path)
    return spark.read.parquet(path)


@query("sink_csv", EXPORT_STRINGS_SQL)
def sink_csv(spark, sf):
    frame, path = _export_frame(spark, sf), work_path(spark, "sink-csv")
    writers.write_csv(frame, path)
    return writers.read_csv(spark, path, frame.columns)


@query("sink_csv_gzip", EXPORT_STRINGS_SQL)
def sink_csv_gzip(spark, sf):
    frame, path = _export_frame(spark, sf), work_path(spark, "sink-csv-gz")
    writers.write_csv_gzip(frame, path)
    return writers.read_csv(spark, path, frame.columns)


@query("sink_export_manifest", f"""
SELECT export, n.n_rows, true AS has_bytes, export <> 'csv' AS smaller_than_csv
FROM (VALUES ('parquet'), ('csv'), ('csv_gzip')) e(export), (SELECT count(*) AS n_rows FROM ({EXPORT_SQL})) n""")
def sink_export_manifest(spark, sf):
    path = work_path(spark, "manifest")
    writers.export(_export_frame(spark, sf), path)
    manifest = writers.export_manifest(spark, path)
    return manifest.select("export", "n_rows", (F.col("n_bytes") > 0).alias("has_bytes"),
                           (F.col("pct_saved") > 0).alias("smaller_than_csv"))


@query("sink_append_new", """
SELECT CASE WHEN doc_id % 40 <> 3 THEN doc_id END AS doc_id, text, lang, source, CASE WHEN doc_id % 40 <> 3 THEN
  CASE WHEN lang IN ('en', 'fr') THEN 'first' ELSE 'second' END END AS batch, CASE WHEN doc_id % 40 = 3 THEN 'no doc_id' END AS reason
FROM documents""")
def sink_append_new(spark, sf):
    keyed = F.when(F.col("doc_id") % 40 != 3, F.col("doc_id")).alias("doc_id")  # some rows come without a key
    docs = table(spark, sf, "documents").select(keyed, "text", "lang", "source")
    path = work_path(spark, "append")
    first = docs.filter(F.col("lang").isin(FIRST_LANGS))
    writers.append_new(spark, first.unionByName(first), path, docs.schema, "doc_id", "first")
    writers.append_new(spark, docs, path, docs.schema, "doc_id", "second")
    writers.append_new(spark, docs, path, docs.schema, "doc_id", "second")  # run again after a failure
    return (spark.read.parquet(path).withColumn("reason", F.lit(None).cast("string"))
            .unionByName(writers.rejects(spark, path, docs.schema, "second").withColumn("batch", F.lit(None).cast("string"))))


@query("sink_append_compacted", "SELECT doc_id, text, lang, source FROM documents")
def sink_append_compacted(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    path = work_path(spark, "compacted")
    for i in range(3):  # every batch repeats what earlier ones brought
        writers.append_new(spark, docs.filter(F.col("doc_id") % 4 <= i), path, docs.schema, "doc_id", f"b{i}")
    keyindex.compact(spark, path, docs.schema, "doc_id", "b1")
    writers.append_new(spark, docs, path, docs.schema, "doc_id", "b3")
    return landing.read_table(spark, path, docs.schema).select(*docs.columns)


@query("sink_full_refresh", star.story_sql("SELECT * FROM story"))
def sink_full_refresh(spark, sf):
    path = work_path(spark, "story")
    stories = star.stories(spark, sf)
    writers.full_refresh(stories.limit(0), path, "v1")
    return writers.full_refresh(stories, path, "v1")  # the same version again, as after a failure


@query("agg_insert_delta", """
SELECT count(*) AS n_fetched, count(*) FILTER (WHERE lang NOT IN ('en', 'fr') AND doc_id % 40 <> 3) AS n_inserted,
       count(*) FILTER (WHERE doc_id % 40 = 3) AS n_rejected,
       count(*) FILTER (WHERE lang IN ('en', 'fr') AND doc_id % 40 <> 3) AS n_skipped FROM documents""")
def agg_insert_delta(spark, sf):
    docs = table(spark, sf, "documents")
    path = work_path(spark, "delta")
    keyed_columns = F.when(F.col("doc_id") % 40 != 3, F.col("doc_id")).alias("doc_id"), F.col("text")
    keyed = docs.select(*keyed_columns)
    writers.append_new(spark, docs.filter(F.col("lang").isin(FIRST_LANGS)).select(*keyed_columns), path, keyed.schema, "doc_id", "first")
    added = writers.append_new(spark, keyed, path, keyed.schema, "doc_id", "second")
    return writers.insert_delta(keyed, added, writers.rejects(spark, path, keyed.schema, "second"))
