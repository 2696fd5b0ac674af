"""The staged run: feed, article, sentence, story, export.

Each stage reads tables, works only on keys its own table lacks, and writes
before the next one starts, so no lineage spans stages and a run that stops can
be repeated under the same batch name.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens import schemas as S
from coverlens.functions import dates, html, text
from coverlens.operators import facet_state
from coverlens.operators.dedup import distinct_on
from coverlens.operators.lookup import pending
from coverlens.plans import dashboard
from coverlens.plans.story import export_view, story_table, web_view
from coverlens.sources import landing, snapshots, writers
from coverlens.sources.dims import inline_rows


def feed_stage(spark: SparkSession, landed: DataFrame, root: str, batch: str, today: dt.date,
               start: dt.date | None = None) -> DataFrame:
    """New records from the last stored day on; returns fetched, inserted, rejected, skipped.

    Records without a date or an id are not lost: they go to the feed's rejects with a reason.

    Batch names must increase.  Only the latest may be run again: the window of an
    older one would start at what later batches stored, and its rows would be lost.
    """
    path = f"{root}/feed"
    stored = landing.read_table(spark, path, writers.batched(S.FEED))
    if stored.filter(F.col(writers.BATCH) > batch).limit(1).count():
        raise ValueError(f"a later batch than {batch} is stored")
    # the window of a repeated batch must not depend on what that batch wrote itself
    window = landing.next_window(stored.filter(F.col(writers.BATCH) < batch), today, start)
    fetched = landing.in_window(landed, *window)
    undated = landing.undated(S.conform(landed, S.FEED))
    added = writers.append_new(spark, fetched, path, S.FEED, "id", batch,
                               [F.col("publish_date"), F.col("url")], rejected=undated)
    return writers.insert_delta(S.conform(fetched, S.FEED).unionByName(undated.drop("reason")), added,
                                writers.rejects(spark, path, S.FEED, batch))


def latest_articles(articles: DataFrame) -> DataFrame:
    """One record per story where failures were retried: a success replaces them, else the earliest failure counts.

    The record is picked on narrow columns, combined map-side; bodies are read and moved once.
    Of records of one moment a hash of their columns decides.
    """
    mine = F.struct(~F.col("success"), "import_date", "error")
    best = articles.groupBy("story_id").agg(F.min(mine).alias("_best"))
    picked = articles.join(best, "story_id").filter(mine.eqNullSafe(F.col("_best"))).drop("_best")
    return distinct_on(picked, ["story_id"], [F.xxhash64(*articles.columns)])


def article_backlog(feed: DataFrame, articles: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Stories without an article record; a failed one counts as done unless retried."""
    done = articles.filter("success") if retry_failed else articles
    return pending(feed.select("id", "url"), done, "id", "story_id")


def backlog_pages(pages: DataFrame, todo: DataFrame) -> DataFrame:
    """The raw page of each story to do, by its URL; NULL where none was crawled.

    The page table is reduced to the backlog's URLs first (a small backlog is broadcast to
    its scan).  Of a page crawled twice one counts, chosen by hashes before the pages move.
    """
    wanted = pages.select("url", "html").join(todo.select("url").distinct(), "url", "left_semi")
    hashed = wanted.withColumn("_hash", F.xxhash64("html"))
    one = hashed.groupBy("url").agg(F.min("_hash").alias("_hash"))
    found = hashed.join(one, ["url", "_hash"]).dropDuplicates(["url"]).drop("_hash")
    return todo.join(found, "url", "left").select("id", "url", "html")


def article_stage(spark: SparkSession, pages: DataFrame, root: str, batch: str, run_ts: Column,
                  retry_failed: bool = False) -> DataFrame:
    """Article records of the backlog; a story whose page is missing gets a failed one."""
    path = f"{root}/article"
    stored = (landing.read_table(spark, path, writers.batched(S.ARTICLE))
              .filter(F.col(writers.BATCH) != batch))
    todo = article_backlog(landing.read_table(spark, f"{root}/feed", S.FEED), stored, retry_failed)
    records = html.article_records(backlog_pages(pages, todo), run_ts)
    if retry_failed:
        # a retry that fails again adds nothing; successes are new by construction
        known = stored.select("story_id").distinct().withColumn("_known", F.lit(True))
        records = (records.join(known, "story_id", "left")
                   .filter(F.col("success") | F.col("_known").isNull()).drop("_known"))
    S.conform(records, S.ARTICLE).write.mode("overwrite").parquet(f"{path}/{writers.BATCH}={batch}")
    added = landing.read_table(spark, f"{path}/{writers.BATCH}={batch}", S.ARTICLE)
    return added.agg(F.count_if(F.col("success")).alias("n_ok"), F.count_if(~F.col("success")).alias("n_failed"))


def sentence_backlog(articles: DataFrame, sentences: DataFrame) -> DataFrame:
    """Articles with text and without a sentence record, as (story_id, text)."""
    return pending(articles.filter(F.col("text") != "").select("story_id", "text"),
                   sentences, "story_id", "story_id")


def stored_sentence_backlog(articles: DataFrame, sentences: DataFrame) -> DataFrame:
    """``sentence_backlog`` of the stored, batch-partitioned article table.

    What is missing is found on keys alone; then only the batches that have
    something missing are read for their text.
    """
    missing = pending(articles.filter("success").select("story_id", writers.BATCH), sentences, "story_id", "story_id")
    # a join on the partition column: Spark prunes the batches by what the other side holds, one name a run.
    # Sent to the scan, as a shuffle by batch would move all texts of a batch to one task
    batches = F.broadcast(missing.select(writers.BATCH).distinct())
    return sentence_backlog(articles.filter("success").join(batches, writers.BATCH, "left_semi"), sentences)


def best_sentences(articles: DataFrame, keyword: str, run_ts: Column) -> DataFrame:
    """One row per article with text: the longest sentence that mentions the keyword, or ''."""
    picked = articles.select("story_id", text.best_sentence(F.col("text"), keyword).alias("sentence"))
    return picked.select("story_id", run_ts.alias("import_date"),
                         text.normalize_quotes(F.col("sentence")).alias("sentence"))


def sentence_stage(spark: SparkSession, root: str, batch: str, keyword: str, run_ts: Column) -> DataFrame:
    path = f"{root}/sentence"
    stored = (landing.read_table(spark, path, writers.batched(S.SENTENCE))
              .filter(F.col(writers.BATCH) != batch))
    articles = landing.read_table(spark, f"{root}/article", writers.batched(S.ARTICLE))
    found = best_sentences(stored_sentence_backlog(articles, stored), keyword, run_ts)
    S.conform(found, S.SENTENCE).write.mode("overwrite").parquet(f"{path}/{writers.BATCH}={batch}")
    added = landing.read_table(spark, f"{path}/{writers.BATCH}={batch}", S.SENTENCE)
    return added.agg(F.count("*").alias("n_checked"), F.count_if(F.col("sentence") != "").alias("n_found"))


KEPT_SNAPSHOTS = 3  # of the story fact, the current one included


def stories(spark: SparkSession, root: str) -> DataFrame:
    """The story fact as of its newest snapshot."""
    return snapshots.read(spark, f"{root}/story", S.STORY)


def _outlet_state(outlets: DataFrame) -> str:
    """Changes whenever a domain gets another outlet."""
    row = outlets.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("domain_name", "id")).alias("hash")).first()
    return f"{row['n']}-{row['hash']}"


def changed_staging(spark: SparkSession, root: str, batch: str, since: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Feed, article and sentence rows of all stories that the batches after ``since``, and ``batch`` itself, say something about.

    Those batches are read by their folders.  Older folders are searched only for stories of which a part
    is older, such as an article that was fetched before its sentence was looked for.
    """
    news = (F.col(writers.BATCH) > since) | (F.col(writers.BATCH) == batch)
    stored = {name: landing.read_table(spark, f"{root}/{name}", writers.batched(schema)).withColumnRenamed(schema.names[0], "_id")
              for name, schema in (("feed", S.FEED), ("article", S.ARTICLE), ("sentence", S.SENTENCE))}
    new, old = ({name: frame.filter(side) for name, frame in stored.items()} for side in (news, ~news))
    ids = new["feed"].select("_id").unionByName(new["article"].select("_id")).unionByName(new["sentence"].select("_id")).distinct()

    def of_ids(name: str, complete_with: str) -> DataFrame:
        # ids whose row of this kind may be in an older folder
        elsewhere = ids.join(new[complete_with].select("_id").distinct(), "_id", "left_anti")
        if elsewhere.isEmpty():
            return new[name]
        return new[name].unionByName(old[name].join(elsewhere, "_id", "left_semi"))

    # a story whose article is new has no older sentence
    feed, articles, sentences = of_ids("feed", "feed"), of_ids("article", "article"), of_ids("sentence", "article")
    return (feed.withColumnRenamed("_id", "id").select(*S.FEED.names), articles.withColumnRenamed("_id", "story_id").select(*S.ARTICLE.names),
            sentences.withColumnRenamed("_id", "story_id").select(*S.SENTENCE.names))


def story_stage(spark: SparkSession, outlets: DataFrame, root: str, batch: str,
                run_ts: dt.datetime | None) -> DataFrame:
    """Take what the batches since the last snapshot brought into the story fact; n_stories counts all of it.

    A URL's earliest record counts, so a stored story gives way only to an earlier record or to a new state of its own.
    The whole fact is made anew the first time and when the outlets changed.  The last KEPT_SNAPSHOTS snapshots stay.
    """
    path = f"{root}/story"
    last, state = snapshots.latest(spark, path), _outlet_state(outlets)
    done = json.loads(last.note) if last else {}
    note = json.dumps({"batch": max(batch, done.get("batch", "")), "outlets": state})
    if done.get("outlets") == state:
        feed, articles, sentences = changed_staging(spark, root, batch, done["batch"])
        rows = S.conform(story_table(feed, latest_articles(articles), sentences, outlets, run_ts), S.STORY)
        snapshots.merge(rows, path, S.STORY, "url", ["publish_date", "feed_id"], "feed_id", note, ignore=["edit_time"])
    else:
        everything = story_table(
            landing.read_table(spark, f"{root}/feed", S.FEED),
            latest_articles(landing.read_table(spark, f"{root}/article", S.ARTICLE)),
            landing.read_table(spark, f"{root}/sentence", S.SENTENCE), outlets, run_ts)
        snapshots.rebuild(S.conform(everything, S.STORY), path, S.STORY, "url", note, ignore=["edit_time"])
    snapshots.expire(spark, path, KEPT_SNAPSHOTS)
    return stories(spark, root).agg(F.count("*").alias("n_stories"))


def facet_counts(spark: SparkSession, outlets: DataFrame, root: str, dims: Sequence[str] = tuple(dashboard.FACETS)) -> DataFrame:
    """The facet state of the web view, brought up to the newest snapshot of the story fact: dims, ``n``.

    Stories added since the last call count one, stories removed or changed minus one, so a call costs what changed.
    The state starts anew when the outlets changed or its snapshot has expired.
    """
    path, now = f"{root}/story", snapshots.latest(spark, f"{root}/story")
    state = f"{root}/facets/{_outlet_state(outlets)}-{'-'.join(dims)}"
    if now is None:
        return facet_state.read(spark, state, web_view(stories(spark, root), outlets).select(*dims).schema)
    shown = lambda rows: web_view(rows, outlets).select(*dims)
    reached = facet_state.latest(spark, state)
    before = snapshots.at(spark, path, int(reached)) if reached else None
    if before is None:
        facet_state.reset(spark, state)
        facet_state.add(shown(stories(spark, root)), None, state, now.name)
    elif before.number < now.number:
        added, removed = snapshots.changes(spark, path, S.STORY, "url", before, now)
        facet_state.add(shown(added), shown(removed), state, now.name)
    return facet_state.read(spark, state, shown(stories(spark, root)).schema)


def export_stage(spark: SparkSession, outlets: DataFrame, root: str, batch: str) -> DataFrame:
    writers.export(export_view(stories(spark, root), outlets), f"{root}/export/{batch}")
    return spark.read.parquet(f"{root}/export/{batch}/parquet").agg(F.count("*").alias("n_exported"))


def run_stages(spark: SparkSession, root: str, landed: DataFrame, pages: DataFrame, outlets: DataFrame,
               keyword: str, batch: str, today: dt.date, start: dt.date | None = None,
               run_ts: dt.datetime | None = None, retry_failed: bool = False) -> DataFrame:
    """Run the five stages in order; returns the run's (batch, stage, metric, value)."""
    stamp = dates.run_timestamp(run_ts)
    results = [
        ("feed", feed_stage(spark, landed, root, batch, today, start)),
        ("article", article_stage(spark, pages, root, batch, stamp, retry_failed)),
        ("sentence", sentence_stage(spark, root, batch, keyword, stamp)),
        ("story", story_stage(spark, outlets, root, batch, run_ts)),
        ("export", export_stage(spark, outlets, root, batch)),
    ]
    rows = [(batch, stage, metric, int(value))
            for stage, counts in results for metric, value in counts.first().asDict().items()]
    metrics = inline_rows(spark, rows, "batch, stage, metric, value")
    return metrics.withColumn("value", F.col("value").cast("bigint"))
