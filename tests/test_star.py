"""Dimensions, lookups, the story fact, the web view and its export."""

import datetime as dt

from pyspark.sql import functions as F

from coverlens import schemas as S
from coverlens.operators import dedup, lookup
from coverlens.plans import story
from coverlens.sources import dims
from tests.conftest import optimized, plan_of

RUN = dt.datetime(2024, 6, 1)


def outlets_csv(spark, rows):
    return spark.createDataFrame(rows, S.OUTLET_CSV)


def test_static_dimensions(spark):
    got = {name: df.collect() for name, df in dims.static_dimensions(spark, RUN).items()}
    assert {n: len(r) for n, r in got.items()} == {"state": 58, "syndicator": 1, "media_outlet_type": 11, "bias_rating": 7}
    assert sum(r["is_state"] for r in got["state"]) == 50
    assert all(r["edit_time"] == RUN for rows in got.values() for r in rows)
    assert [r["name"] for r in got["bias_rating"] if r["ordering"] == 3] == ["Center", "Mixed"]
    assert len({r["name"] for r in got["state"]}) == len({r["code"] for r in got["state"]}) == 58


def test_inline_rows_keep_quotes(spark):
    df = dims.inline_rows(spark, [("it's \\ \"x\"", None, True, 1.5)], "a, b, c, d")
    assert tuple(df.first()) == ("it's \\ \"x\"", None, True, 1.5) or float(df.first()["d"]) == 1.5


def test_outlet_dimension(spark):
    staged = outlets_csv(spark, [
        ("Daily", "daily.com", "Blog", "Ohio", "Left", True),
        ("Weekly", "weekly.com", "Trade Journal", "Ohio", "Left", True),   # no such type
        ("Monthly", "monthly.com", "Blog", "Atlantis", "Left", True),      # no such state
        ("Yearly", "yearly.com", "Blog", "Ohio", "Sideways", True),        # no such bias
        ("Daily B", "daily.com", "Court Documents", "Utah", "Right", True),  # domain listed twice
        ("Unspecified", "x.com", "Blog", "Ohio", "Left", True),            # reserved name
        ("Closed", "closed.com", "Other", "Unspecified", "Unspecified", False),
    ])
    own = dims.member_row("Own", "own.org", media_outlet_type_id=8, bias_rating_id=4)
    rows = {r["name"]: r for r in dims.outlet_dimension(spark, staged, RUN, [own]).collect()}
    assert set(rows) == {"Unspecified", "Daily", "Closed", "Own"}
    assert rows["Unspecified"]["id"] == 1 and rows["Unspecified"]["domain_name"] == "None"
    assert (rows["Daily"]["media_outlet_type_id"], rows["Daily"]["state_id"], rows["Daily"]["bias_rating_id"]) == (11, 36, 2)
    assert (rows["Own"]["media_outlet_type_id"], rows["Own"]["state_id"]) == (8, 1)
    assert len({r["id"] for r in rows.values()}) == 4 and rows["Closed"]["active"] is False
    # keys do not change when the dimension is rebuilt in another order
    again = {r["name"]: r["id"] for r in dims.outlet_dimension(spark, staged.orderBy(F.desc("name")), RUN, [own]).collect()}
    assert again == {n: r["id"] for n, r in rows.items()}


def test_read_outlets_csv(spark, tmp_path):
    (tmp_path / "o.csv").write_text(
        'name,domain_name,media_outlet_type,state,bias,active\n"A, ""B""",a.com,Blog,Ohio,Left,true\nC,c.com,Blog,Ohio,Left,FALSE\n')
    rows = dims.read_outlets_csv(spark, str(tmp_path)).orderBy("name").collect()
    assert [tuple(r) for r in rows] == [('A, "B"', "a.com", "Blog", "Ohio", "Left", True), ("C", "c.com", "Blog", "Ohio", "Left", False)]
    inferred = dims.read_outlets_csv(spark, str(tmp_path), infer=True)
    assert dict(inferred.dtypes)["active"] == "boolean" and inferred.count() == 2


def test_salted_lookup_gives_the_same_rows(spark):
    fact = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"))
    dim = spark.range(40).select(F.when(F.col("id") == 39, "hot").otherwise(F.col("id").cast("string")).alias("key"), F.col("id").alias("v"))
    plain = lookup.lookup_default(fact, dim, "k", "key", {"v": -1})
    salted = lookup.lookup_default(fact, dim, "k", "key", {"v": -1}, salts=7, spread=F.col("id"))
    assert salted.columns == plain.columns
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))
    assert plain.filter("v = -1").count() > 0


def test_pending_survives_null_and_repeated_keys(spark):
    todo = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    done = spark.createDataFrame([("a",), ("a",), (None,)], "done_id string")
    assert {r["id"] for r in lookup.pending(todo, done, "id", "done_id").collect()} == {"b", None}


def test_only_new(spark):
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "id string, v int")
    stored = spark.createDataFrame([("b",), ("b",), ("z",)], "id string")
    assert {tuple(r) for r in lookup.only_new(batch, stored, "id").collect()} == {("a", 1), ("c", 3)}
    assert lookup.only_new(batch, stored.limit(0), "id").count() == 3
    assert lookup.only_new(batch.limit(0), stored, "id").count() == 0


def test_distinct_on_prunes_before_the_exchange(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 100).alias("k"))
    kept = dedup.distinct_on(df, ["k"], [F.desc("id")])
    plan = plan_of(kept)
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")
    expected = {}
    for r in df.collect():
        expected[r["k"]] = max(expected.get(r["k"], -1), r["id"])
    assert {r["k"]: r["id"] for r in kept.collect()} == expected


def test_distinct_on_wide_equals_distinct_on(spark):
    df = spark.range(3000).select("id", F.concat(F.lit("text "), (F.col("id") % 17).cast("string")).alias("t"), (F.col("id") % 5).alias("o"))
    wide = dedup.distinct_on_wide(df, F.col("t"), ["o", "id"], "id")
    plain = dedup.distinct_on(df, ["t"], [F.col("o"), F.col("id")])
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, plain.select(wide.columns).collect()))
    assert dedup.first_per_group(df, "t", F.col("id"), F.struct("o", "id")).count() == 17


# --- the fact -------------------------------------------------------------------------

FEED = [  # id, publish_date, title, url, language, media_url
    ("1", "2024-01-02", "Feed one", "u1", "en", "daily.com"),
    ("2", "2024-01-01", "Feed two", "u1", "en", "daily.com"),      # same url, earlier
    ("3", None, "No date", "u3", None, "Daily.com"),               # case differs: no outlet
    ("4", "2024-01-04", "Failed page", "u4", "es", "closed.com"),
    ("5", "2024-01-05", "No article yet", "u5", "en", "daily.com"),
    ("6", "2024-01-05", "", "u6", "en", None),
    ("7", "2023-01-01", "Earliest, but no article", "u1", "en", "daily.com"),
]
ARTICLES = [  # story_id, authors, top_image, text, summary, success
    ("1", "Ann, .Wp-x", "i1", "b1", "s1", True), ("2", ".Wp-y", "i2", "b2", "s2", True),
    ("3", None, None, "b3", None, True), ("4", "", "", "", "", False), ("6", "Bo", "", "b6", "", True),
]


def star(spark):
    feed = spark.createDataFrame(FEED, S.FEED)
    articles = S.conform(spark.createDataFrame(
        ARTICLES, "story_id string, authors string, top_image string, text string, summary string, success boolean"), S.ARTICLE)
    sentences = spark.createDataFrame([("1", RUN, "said one"), ("2", RUN, "")], S.SENTENCE)
    staged = outlets_csv(spark, [("Daily", "daily.com", "Blog", "Ohio", "Left", True),
                                 ("Closed", "closed.com", "Blog", "Unspecified", "Mixed", False)])
    return feed, articles, sentences, dims.outlet_dimension(spark, staged, RUN)


def test_staged_stories_and_story_table(spark):
    parts = star(spark)
    staged = {r["feed_id"]: r for r in story.staged_stories(*parts).collect()}
    assert set(staged) == {"1", "2", "3", "4", "6"}  # a story without an article record is not there yet
    assert staged["4"]["body"] == "" and staged["4"]["success"] is False  # a failed page is
    assert staged["1"]["title"] == "Feed one" and staged["1"]["authors"] == "Ann" and staged["2"]["authors"] == ""
    assert staged["3"]["media_outlet_id"] == 1 and staged["6"]["media_outlet_id"] == 1
    assert staged["3"]["publish_date"] == dt.date(2000, 1, 1) and staged["3"]["sentence"] == ""

    stories = story.story_table(*parts, RUN)
    rows = {r["url"]: r for r in stories.collect()}
    assert stories.count() == len(rows) == 4
    assert rows["u1"]["feed_id"] == "2"  # the earliest with an article
    assert (rows["u3"]["language"], rows["u3"]["authors"], rows["u3"]["image"], rows["u3"]["summary"]) == ("en", "", "", "")
    assert {f.name: f.dataType for f in stories.schema} == {f.name: f.dataType for f in S.STORY}
    assert stories.columns == S.STORY.fieldNames()
    again = {r["url"]: r["id"] for r in story.story_table(*parts, RUN, salts=5).collect()}
    assert again == {u: r["id"] for u, r in rows.items()}


def test_web_view_and_export(spark):
    parts = star(spark)
    view = story.web_view(story.story_table(*parts, RUN), parts[3])
    rows = {r["url"]: r for r in view.collect()}
    assert set(rows) == {"u1", "u3", "u6"}  # the closed outlet's story is hidden
    assert rows["u1"]["state"] == "Ohio" and rows["u1"]["state_code"] == "OH" and rows["u1"]["syndicator"] == "None"
    assert rows["u3"]["state"] == "National" and rows["u3"]["media_outlet"] == "Unspecified"
    export = story.export_frame(view)
    assert export.columns == ["id", "publishDate", "title", "url", "authors", "image", "summary", "language", "mediaOutlet",
                              "mediaOutletType", "state", "stateCode", "biasRating", "sentence", "syndicator"]
    assert [r["url"] for r in export.collect()] == ["u1"] and export.count() <= view.count()


def test_web_view_plan(spark, tmp_path):
    parts = star(spark)
    names = ("feed", "articles", "sentences", "outlets")
    for name, df in zip(names, parts):
        df.write.parquet(f"{tmp_path}/{name}")
    stored = [spark.read.parquet(f"{tmp_path}/{n}") for n in names]
    story.story_table(*stored, RUN).write.parquet(f"{tmp_path}/story")
    view = story.web_view(spark.read.parquet(f"{tmp_path}/story"), stored[3])
    plan = plan_of(view)
    scan = [line for line in plan.splitlines() if "FileScan" in line and "feed_id" not in line and "sentence" in line][0]
    assert "body" not in scan.split("ReadSchema")[1]
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    # the outlet filter of the export reaches the outlet scan
    assert "Unspecified" in [line for line in optimized(story.export_frame(view)).splitlines() if "Filter" in line and "name" in line][0]


def test_hot_url_and_hot_domain(spark):
    """A third of the feed shares one url, all of it one domain."""
    n = 6000
    feed = spark.range(n).select(
        F.col("id").cast("string").alias("id"), F.lit("2024-01-01").alias("publish_date"), F.lit("t").alias("title"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("url"),
        F.lit("en").alias("language"), F.lit("daily.com").alias("media_url"))
    articles = S.conform(feed.select(F.col("id").alias("story_id"), F.lit("b").alias("text"), F.lit(True).alias("success")), S.ARTICLE)
    sentences = spark.createDataFrame([], S.SENTENCE)
    outlets = star(spark)[3]
    for salts in (1, 4):
        got = story.story_table(feed, articles, sentences, outlets, RUN, salts)
        assert got.count() == n - n // 3 + 1
        assert got.filter("url = 'hot'").first()["feed_id"] == "0"


def test_stories_of_the_unspecified_outlet_are_spread(spark):
    outlets = dims.outlet_dimension(spark, outlets_csv(spark, [("Daily", "daily.com", "Blog", "Ohio", "Left", True)]), RUN)
    known = {r["domain_name"]: r["id"] for r in outlets.collect()}
    given = {"id": F.md5(F.col("n").cast("string")), "syndicator_id": F.lit(1), "active": F.lit(True),
             "media_outlet_id": F.when(F.col("n") < 2000, S.DEFAULT_ID).when(F.col("n") < 2003, known["daily.com"]).when(F.col("n") < 2005, 99)}
    stories = spark.range(2006).withColumnRenamed("id", "n").select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.STORY.fields])
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        view = story.web_view(stories, outlets)
        assert "SortMergeJoin" in plan_of(view)
        tasks = [r["count"] for r in view.groupBy(F.spark_partition_id().alias("task")).count().collect()]
        rows = sorted((r["media_outlet"], r["n"]) for r in view.groupBy("media_outlet").agg(F.count("*").alias("n")).collect())
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert rows == [("Daily", 3), (S.UNSPECIFIED, 2000)] and view.count() == view.select("id").distinct().count()
    assert len(tasks) == 4 and max(tasks) < 1000  # one task had all 2,000 of them
