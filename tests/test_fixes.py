"""Repeated versions, keywords with dots, short forms, names with quotes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from coverlens.functions import display, sql_functions, text
from coverlens import schemas as S
from coverlens.plans import stages, story
from coverlens.sources import landing, writers
from coverlens.streaming import incremental


def test_a_failing_repeat_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.full_refresh(spark.range(5), path, "v1")
    with pytest.raises(Exception):
        writers.full_refresh(spark.range(3).select(F.raise_error(F.lit("stop")).cast("bigint").alias("id")), path, "v1")
    assert writers.current(spark, path).count() == 5
    assert writers.full_refresh(spark.range(3), path, "v1").count() == 3
    assert writers.full_refresh(spark.range(2), path, "v0").count() == 2  # the latest written counts


def test_keywords_with_dots(column):
    given = ["See example.org now.", "The U.S. aid bill.", "us aid", "no match", None]
    assert column(given, text.mentions(F.col("v"), "example.org")) == [True, False, False, False, None]
    assert column(given, text.mentions(F.col("v"), "U.S. aid")) == [False, True, True, False, None]
    with pytest.raises(ValueError):
        text.mentions(F.col("v"), " . ")


def test_short_forms_do_not_end_a_sentence(column):
    given = ["It was No. 5 of many. Yes.", "He read Inc. magazine. Then left.", "At 9 p.m. Monday it rained. So what.",
             "She said no. That was it.", "Founded by Acme Inc. The rest followed."]
    assert column(given, F.array_join(text.sentences(F.col("v")), "|")) == [
        "It was No. 5 of many.|Yes.", "He read Inc. magazine.|Then left.", "At 9 p.m. Monday it rained.|So what.",
        "She said no.|That was it.", "Founded by Acme Inc.|The rest followed."]


def test_slugs_and_clocks(column):
    assert column(["A\xa0b  C", "--x -!- y--", "", "it's_ok"], display.slugify(F.col("v"))) == ["a-b-c", "x-y", "", "its_ok"]
    assert column([0, 59, 3600, 360061], display.seconds_to_clock(F.col("v")), "long") == ["0:00:00", "0:00:59", "1:00:00", "100:01:01"]


def test_camel_case():
    assert list(map(story.camel_case, ["id", "media_outlet_type", "state_code"])) == ["id", "mediaOutletType", "stateCode"]


@pytest.mark.parametrize("marker", [".Wp-", "50%_'x\\"])
def test_byline_marker_of_any_characters(spark, marker):
    sql_functions.register(spark, marker)
    rows = [(marker + "block",), ("Ann, " + marker + "a, " + marker + "b",), ("Ann",), ("Ann " + marker,), ("",), (None,)]
    frame = spark.createDataFrame(rows, "byline string")
    got = frame.select(F.expr("clean_byline(byline)").alias("a"), text.clean_byline(F.col("byline"), marker).alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got] == ["", "Ann", "Ann", "Ann " + marker, "", None]


def test_rows_without_a_key_are_rejected_not_merged(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c"), (1, "d")], "id long, note string")
    for batch in ("b1", "b2", "b2"):
        added = writers.append_new(spark, rows, path, rows.schema, "id", batch)
    assert added.count() == 0 and spark.read.parquet(path).count() == 1
    refused = writers.rejects(spark, path, rows.schema, "b2")
    assert sorted((r["note"], r["reason"]) for r in refused.collect()) == [("b", "no id"), ("c", "no id")]
    counts = writers.insert_delta(rows, added, refused).first().asDict()
    assert counts == {"n_fetched": 4, "n_inserted": 0, "n_rejected": 2, "n_skipped": 2}


def test_undated_feed_rows(spark):
    feed = spark.createDataFrame([("1", None), ("2", "05/01/2024"), ("3", "2024-05-01"), ("4", "soon")], "id string, publish_date string")
    day = dt.date(2024, 5, 1)
    assert [r["id"] for r in landing.in_window(feed, day, day).orderBy("id").collect()] == ["2", "3"]
    assert [(r["id"], r["reason"]) for r in landing.undated(feed).orderBy("id").collect()] == [
        ("1", "no publish date"), ("4", "no publish date")]


def test_stories_without_url(spark):
    feed = spark.createDataFrame([("1", None), ("2", None), ("3", "u")], "id string, url string")
    assert [r["id"] for r in story.without_url(feed).orderBy("id").collect()] == ["1", "2"]


def test_late_rows_of_a_bounded_stream(spark, tmp_path):
    target, schema = str(tmp_path / "t"), spark.createDataFrame([], "id long, at timestamp").schema
    at = lambda day: dt.datetime(2024, 1, day)
    for rows in ([(1, at(20)), (3, at(21))], [(2, at(1)), (2, at(1)), (1, at(20))]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = incremental.stream_files(spark, str(tmp_path / "in"), schema)
        kept = incremental.bounded_dedup(stream, "id", "at", "1 hour")
        incremental.stream_table(kept, target, str(tmp_path / "c")).awaitTermination()
    delivered = spark.read.schema(schema).parquet(str(tmp_path / "in"))
    for _ in range(2):
        incremental.append_late(spark, delivered, target, "id")
    assert sorted(r["id"] for r in incremental.read_all(spark, target, schema).collect()) == [1, 2, 3]


def test_a_table_without_its_key_column_is_refused(spark):
    schema = spark.createDataFrame([], "id long, note string").schema
    assert S.conform(spark.range(1), schema).first()["note"] is None
    with pytest.raises(ValueError):
        S.conform(spark.range(1).withColumnRenamed("id", "key"), schema)


def test_latest_articles_reads_bodies_once(spark, tmp_path):
    rows = [("1", False, dt.datetime(2024, 1, 1), "no page", ""), ("1", True, dt.datetime(2024, 1, 2), None, "body"),
            ("2", False, dt.datetime(2024, 1, 3), "no page", ""), ("2", False, dt.datetime(2024, 1, 1), "no body text", ""),
            ("3", True, dt.datetime(2024, 1, 1), None, "text")]
    spark.createDataFrame(rows, "story_id string, success boolean, import_date timestamp, error string, text string").write.parquet(
        str(tmp_path / "t"))
    latest = stages.latest_articles(spark.read.parquet(str(tmp_path / "t")))
    assert sorted((r["story_id"], r["success"], r["error"], r["text"]) for r in latest.collect()) == [
        ("1", True, None, "body"), ("2", False, "no body text", ""), ("3", True, None, "text")]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("text#") and sum("text:string" in line for line in plan.splitlines() if "ReadSchema" in line) <= 2
