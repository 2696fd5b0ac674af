"""Runs that cost what is new: the key index, snapshots, the incremental story fact."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from coverlens import schemas as S
from coverlens.plans import stages, story
from coverlens.session import work_path
from coverlens.sources import dims, files, keyindex, landing, snapshots, writers
from tests.conftest import plan_of


def keyed(spark, ids, note="n"):
    return spark.createDataFrame([(str(i), note) for i in ids], "id string, note string")


def scanned_files(frame) -> int:
    """Files that the scan of a plan of one stage opened."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


# --- key index --------------------------------------------------------------------------

def test_a_batch_opens_the_buckets_it_touches(spark):
    path, schema = work_path(spark, "t"), keyed(spark, [1]).schema
    writers.append_new(spark, keyed(spark, range(3000)), path, schema, "id", "b1")
    index = keyindex.index_path(path)
    assert len([f for f in files.folders(spark, f"{index}/batch=b1") if f.startswith("key_bucket=")]) == 64
    buckets = {r["id"]: r["b"] for r in keyed(spark, range(9000)).select("id", keyindex.bucket_of(F.col("id")).alias("b")).collect()}
    one = [k for k, b in buckets.items() if b == 5]
    assert len(one) > 100
    wanted = keyed(spark, one)
    found = keyindex.lookup(spark, path, schema, "id", wanted)
    assert sorted(r["id"] for r in found.collect()) == sorted(k for k in one if int(k) < 3000)
    assert "key_bucket" in plan_of(found) and "PartitionFilters" in plan_of(found)
    stored = landing.read_table(spark, index, keyindex.index_schema(schema, "id"))
    assert scanned_files(stored.filter(F.col("key_bucket").isin([5])).select("id")) == 1 < scanned_files(stored.select("id"))
    # a few keys are looked up by value: the filter reaches the scan and its Bloom filters
    few = keyindex.lookup(spark, path, schema, "id", keyed(spark, [7, 100000]))
    assert "PushedFilters: [In(id, [100000,7])" in plan_of(few) and [r["id"] for r in few.collect()] == ["7"]
    assert writers.append_new(spark, wanted, path, schema, "id", "b2").count() == sum(int(k) >= 3000 for k in one)


def test_unindexed_batches_are_found(spark):
    path, schema = work_path(spark, "t"), keyed(spark, [1]).schema
    keyed(spark, range(10)).write.parquet(f"{path}/batch=a1")  # a table older than its index
    assert writers.append_new(spark, keyed(spark, range(5, 15)), path, schema, "id", "a2").count() == 5
    # stopped between rows and index: the next batch must still know the rows
    keyindex.forget_batch(spark, path, "a2")
    assert writers.append_new(spark, keyed(spark, range(20)), path, schema, "id", "a3").count() == 5
    assert keyindex.repair(spark, path, schema, "id") == []
    # run again with other rows: the index follows
    assert writers.append_new(spark, keyed(spark, range(14, 18)), path, schema, "id", "a3").count() == 3
    assert writers.append_new(spark, keyed(spark, range(20)), path, schema, "id", "a4").count() == 2


@pytest.mark.parametrize("stop", [None, "before", "between"])
def test_compaction(spark, stop):
    path, schema = work_path(spark, "t"), keyed(spark, [1]).schema
    for i in range(4):
        writers.append_new(spark, keyed(spark, range(10 * i, 10 * i + 15)), path, schema, "id", f"b{i}")
    rows = lambda: sorted(r["id"] for r in landing.read_table(spark, path, schema).collect())
    before = rows()
    if stop == "before":  # the merged rows were never complete
        keyed(spark, [1, 2]).write.parquet(f"{path}/_merged-b2")
        files.remove(spark, f"{path}/_merged-b2/_SUCCESS")
    if stop == "between":  # merged rows complete, some of the old folders gone
        landing.read_table(spark, path, writers.batched(schema)).filter("batch <= 'b2'").drop("batch").write.parquet(f"{path}/_merged-b2")
        files.remove(spark, f"{path}/batch=b1")
        assert writers.append_new(spark, keyed(spark, range(45)), path, schema, "id", "b4").count() == 0
    else:
        assert keyindex.compact(spark, path, schema, "id", "b2") == 3
    assert rows() == before
    assert [f for f in files.folders(spark, path) if f < "batch=b4"] == ["batch=b2", "batch=b3"]
    assert writers.append_new(spark, keyed(spark, range(50)), path, schema, "id", "b5").count() == 5
    assert keyindex.repair(spark, path, schema, "id") == []


# --- snapshots --------------------------------------------------------------------------

ROW = "k string, day int, record string, body string"


def frame(spark, rows):
    return spark.createDataFrame(rows, ROW)


def take(spark, rows, path, note=""):
    return snapshots.merge(frame(spark, rows), path, frame(spark, []).schema, "k", ["day", "record"], "record", note, parts=16)


def held(spark, path, snapshot=None):
    return sorted(tuple(r) for r in snapshots.read(spark, path, frame(spark, []).schema, snapshot).collect())


def test_merge_writes_what_it_touches(spark):
    path = work_path(spark, "t")
    assert held(spark, path) == []
    first = take(spark, [(f"k{i}", 5, f"r{i}", "body") for i in range(200)], path)
    assert len(first.folders) == 16
    second = take(spark, [("k3", 4, "r900", "earlier"), ("new", 9, "r901", "b"), ("k4", 6, "r902", "later"), (None, 1, "r", "x")], path)
    part = {r["k"]: r["p"] for r in spark.createDataFrame([("k3",), ("new",)], "k string").select("k", snapshots._part_of("k", 16).alias("p")).collect()}
    changed = {p for p in second.folders if second.folders[p] != first.folders[p]}
    assert changed == set(part.values())
    assert len(second.folders[part["new"]]) == 2 or part["new"] == part["k3"]  # nothing there was rewritten
    rows = {r[0]: r for r in held(spark, path)}
    assert len(rows) == 201 and rows["k3"][1:] == (4, "r900", "earlier") and rows["k4"][2] == "r4"
    assert len(held(spark, path, first)) == 200  # the old snapshot is still there


def test_merge_makes_the_rows_once(spark):
    """Which partitions are touched is found on keys alone, not by making all columns a first time."""
    path, made = work_path(spark, "t"), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def body(k):
        made.add(1)
        return f"body of {k}"

    for n, upto in enumerate((20, 50)):
        rows = spark.range(upto).select(F.col("id").cast("string").alias("k"), F.lit(5).alias("day"), F.col("id").cast("string").alias("record"))
        rows = rows.withColumn("body", body("k"))
        before = made.value
        snapshots.merge(rows, path, frame(spark, []).schema, "k", ["day", "record"], "record", parts=16)
        assert made.value - before == upto and len(held(spark, path)) == upto


def test_the_same_record_is_replaced_and_a_repeat_changes_nothing(spark):
    path = work_path(spark, "t")
    take(spark, [("a", 5, "r1", ""), ("b", 5, "r2", "x")], path)
    done = take(spark, [("a", 5, "r1", "retried")], path)
    assert held(spark, path) == [("a", 5, "r1", "retried"), ("b", 5, "r2", "x")]
    assert take(spark, [("a", 5, "r1", "retried"), ("b", 6, "r9", "later")], path) == done
    assert take(spark, [], path) == done and take(spark, [], path, note="other").number == done.number + 1
    assert snapshots.latest(spark, path).folders == done.folders


def test_a_failed_attempt_changes_nothing(spark):
    path = work_path(spark, "t")
    take(spark, [("a", 5, "r1", "x")], path)
    bad = frame(spark, [("b", 5, "r2", "x")]).withColumn("body", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        snapshots.merge(bad, path, bad.schema, "k", ["day", "record"], "record")
    spark.createDataFrame([(9, 16, "", 0, "nowhere")], "number int, parts int, note string, part int, folder string").write.json(f"{path}/snapshots/000000002")
    files.remove(spark, f"{path}/snapshots/000000002/_SUCCESS")  # stopped while the snapshot was written
    assert held(spark, path) == [("a", 5, "r1", "x")]
    assert take(spark, [("c", 1, "r3", "z")], path).number == 2 and len(held(spark, path)) == 2


def test_partitions_of_many_folders_are_merged_and_old_snapshots_expire(spark):
    path, want = work_path(spark, "t"), {}
    for i in range(snapshots.MOST_FOLDERS + 3):
        rows = [(f"k{j % 40}", 100 - i - j % 3, f"r{i}-{j}", "b" * i) for j in range(i, 60, 3)]
        for r in rows:
            want[r[0]] = min(want.get(r[0], r), r, key=lambda r: (r[1], r[2]))
        take(spark, rows, path)
    assert max(map(len, snapshots.latest(spark, path).folders.values())) <= snapshots.MOST_FOLDERS + 1
    assert held(spark, path) == sorted(want.values())
    assert snapshots.expire(spark, path, keep=1) > 0 and held(spark, path) == sorted(want.values())
    assert snapshots.expire(spark, path, keep=1) == 0
    take(spark, [("last", 1, "r", "")], path)
    assert len(held(spark, path)) == len(want) + 1


def test_versions_expire(spark):
    path = work_path(spark, "t")
    for i in range(4):
        writers.full_refresh(spark.range(i), path, f"v{i}")
    assert writers.expire_versions(spark, path, keep=2) == 2
    assert writers.current(spark, path).count() == 3 and writers.expire_versions(spark, path) == 0


# --- the story fact ----------------------------------------------------------------------

RUN = dt.datetime(2024, 6, 1)
ARTICLE = '<html><body><article><h1>T</h1><p>{} The example institute said {}.</p></article></body></html>'


def pages_of(spark, numbers, note=""):
    rows = [(f"http://s{i}.example.com/{i}", ARTICLE.format("Some words. " * 5, f"number {i}{note}")) for i in numbers]
    return spark.createDataFrame(rows, "url string, html string")


def feed_of(spark, rows):
    return spark.createDataFrame([(f"id{k}", f"2024-03-{day:02d}", f"t{k}", f"http://s{i}.example.com/{i}" if i is not None else None,
                                   "en", f"s{i}.example.com") for k, day, i in rows], S.FEED)


def outlets_of(spark, domains):
    staged = spark.createDataFrame([(f"Outlet {d}", d, "Blog", "Ohio", "Left", True) for d in domains], S.OUTLET_CSV)
    return dims.outlet_dimension(spark, staged, RUN)


def full_fact(spark, root, outlets):
    rows = story.story_table(
        landing.read_table(spark, f"{root}/feed", S.FEED), stages.latest_articles(landing.read_table(spark, f"{root}/article", S.ARTICLE)),
        landing.read_table(spark, f"{root}/sentence", S.SENTENCE), outlets, RUN)
    return sorted(tuple(r) for r in S.conform(rows, S.STORY).collect())


def run(spark, root, batch, feed, pages, outlets, today=dt.date(2024, 3, 31), **more):
    return {(r["stage"], r["metric"]): r["value"] for r in stages.run_stages(
        spark, root, feed, pages, outlets, "example institute", batch, today, dt.date(2024, 3, 1), RUN, **more).collect()}


def facts(spark, root):
    return sorted(tuple(r) for r in stages.stories(spark, root).collect())


def test_story_fact_grows_with_the_batch(spark):
    root, outlets = work_path(spark, "runs"), outlets_of(spark, ["s1.example.com", "s2.example.com"])
    first = feed_of(spark, [(i, 10, i) for i in range(60)])
    assert run(spark, root, "r1", first, pages_of(spark, range(50)), outlets)["story", "n_stories"] == 60
    one = snapshots.latest(spark, f"{root}/story")
    assert facts(spark, root) == full_fact(spark, root, outlets)
    # new URLs, an earlier record of a stored URL, a later one of another, pages that were missing
    second = feed_of(spark, [(100, 12, 100), (101, 10, 7), ("00", 10, 7), (102, 20, 8), (103, 11, None)])
    got = run(spark, root, "r2", first.unionByName(second), pages_of(spark, list(range(58)) + [100]), outlets, retry_failed=True)
    two = snapshots.latest(spark, f"{root}/story")
    assert got["story", "n_stories"] == 61 and got["article", "n_ok"] == 12
    assert facts(spark, root) == full_fact(spark, root, outlets)
    assert {r["feed_id"] for r in stages.stories(spark, root).filter("url like '%/7'").collect()} == {"id00"}
    changed = {p for p in two.folders if one.folders.get(p) != two.folders[p]}
    urls = spark.createDataFrame([(f"http://s{i}.example.com/{i}",) for i in [7, 100, *range(50, 58)]], "url string")
    assert changed == {r[0] for r in urls.select(snapshots._part_of("url", two.parts)).collect()} and len(changed) < 0.3 * two.parts
    # the same run again, and one that brings nothing
    run(spark, root, "r2", first.unionByName(second), pages_of(spark, list(range(58)) + [100]), outlets, retry_failed=True)
    assert snapshots.latest(spark, f"{root}/story") == two
    run(spark, root, "r3", first.unionByName(second), pages_of(spark, range(50)), outlets)
    assert snapshots.latest(spark, f"{root}/story").folders == two.folders


def test_a_run_that_stopped_is_taken_in_by_the_next(spark):
    root, outlets = work_path(spark, "runs"), outlets_of(spark, ["s1.example.com"])
    stamp = F.lit(RUN)
    run(spark, root, "r1", feed_of(spark, [(i, 10, i) for i in range(10)]), pages_of(spark, range(10)), outlets)
    feed = feed_of(spark, [(i, 12, i) for i in range(20, 25)])
    stages.feed_stage(spark, feed, root, "r2", dt.date(2024, 3, 31))
    stages.article_stage(spark, pages_of(spark, range(40)), root, "r2", stamp)  # stopped before sentences and stories
    run(spark, root, "r3", feed.unionByName(feed_of(spark, [(30, 15, 30)])), pages_of(spark, range(40)), outlets)
    assert len(facts(spark, root)) == 16 and facts(spark, root) == full_fact(spark, root, outlets)
    assert stages.stories(spark, root).filter("sentence <> ''").count() == 16
    feed = feed_of(spark, [(i, 16, i) for i in range(31, 34)])
    stages.feed_stage(spark, feed, root, "r4", dt.date(2024, 3, 31))
    stages.article_stage(spark, pages_of(spark, range(40)), root, "r4", stamp)
    stages.sentence_stage(spark, root, "r4", "example institute", stamp)  # stopped before stories
    run(spark, root, "r5", feed, pages_of(spark, range(40)), outlets)
    assert len(facts(spark, root)) == 19 and facts(spark, root) == full_fact(spark, root, outlets)


def test_texts_of_a_batch_are_not_shuffled_by_batch(spark):
    path = work_path(spark, "t")
    rows = lambda ids: spark.createDataFrame([(f"id{i}", f"text {i}", i % 7 != 0) for i in ids], "story_id string, text string, success boolean")
    rows(range(40)).write.parquet(f"{path}/batch=r1")
    rows(range(40, 100)).write.parquet(f"{path}/batch=r2")
    articles = spark.read.parquet(path)
    sentences = rows(i for i in range(42) if i != 3).select("story_id", F.lit("").alias("sentence"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if both sides were large
    try:
        got = stages.stored_sentence_backlog(articles, sentences)
        assert sorted(tuple(r) for r in got.collect()) == sorted(
            (f"id{i}", f"text {i}") for i in [3, *range(42, 100)] if i % 7)
        joins = [line for line in plan_of(got).splitlines() if "Join [batch" in line]
        assert joins and all("BroadcastHashJoin" in line for line in joins)
        assert "dynamicpruning" in plan_of(got)  # batches that lack nothing are not read
        late = stages.stored_sentence_backlog(articles, sentences.unionByName(rows([3]).select("story_id", F.lit("").alias("sentence"))))
        assert sorted(r["story_id"] for r in late.collect()) == sorted(f"id{i}" for i in range(42, 100) if i % 7)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_changed_outlets_make_the_fact_anew(spark):
    root = work_path(spark, "runs")
    feed, pages = feed_of(spark, [(i, 10, i) for i in range(6)]), pages_of(spark, range(6))
    run(spark, root, "r1", feed, pages, outlets_of(spark, ["s1.example.com"]))
    more = outlets_of(spark, ["s1.example.com", "s2.example.com"])
    run(spark, root, "r2", feed, pages, more)
    assert facts(spark, root) == full_fact(spark, root, more)
    assert stages.stories(spark, root).filter(F.col("media_outlet_id") != S.DEFAULT_ID).count() == 2
    for i in range(2):
        run(spark, root, f"s{i}", feed_of(spark, [(50 + i, 11, 50 + i)]), pages, more)
    assert len(files.folders(spark, f"{root}/story/snapshots")) == stages.KEPT_SNAPSHOTS and len(facts(spark, root)) == 8


def test_facet_counts_follow_the_fact(spark, monkeypatch):
    from coverlens.operators import facet_state, facets
    from coverlens.plans import dashboard

    root, outlets = work_path(spark, "runs"), outlets_of(spark, [f"s{i}.example.com" for i in range(0, 90, 2)])
    dims_ = list(dashboard.FACETS)
    pages = pages_of(spark, range(90))
    one_scan = lambda known: {(r["dim"], r["key"]): r["n"] for r in facets.crossfilter(
        story.web_view(stages.stories(spark, root), known), dims_, {}, with_total=True).collect()}
    counted = lambda known: {(r["dim"], r["key"]): r["n"] for r in facets.crossfilter(
        stages.facet_counts(spark, known, root), dims_, {}, with_total=True, weight=facet_state.COUNT).collect()}
    assert stages.facet_counts(spark, outlets, root).count() == 0
    run(spark, root, "r1", feed_of(spark, [(i, 10, i) for i in range(20)]), pages, outlets)
    assert counted(outlets) == one_scan(outlets) and one_scan(outlets)["total", ""] == 20
    # one URL's story gives way to an earlier record that names another outlet
    moved = [("00", 10, 4)] + [(i, 12, i) for i in range(30, 40)]
    feed = feed_of(spark, moved).withColumn("media_url", F.when(F.col("id") == "id00", "s6.example.com").otherwise(F.col("media_url")))
    run(spark, root, "r2", feed, pages, outlets)
    assert counted(outlets) == one_scan(outlets) and one_scan(outlets)["media_outlet", "Outlet s6.example.com"] == 2
    assert ("media_outlet", "Outlet s4.example.com") not in counted(outlets)
    assert counted(outlets) == one_scan(outlets)  # nothing new
    monkeypatch.setattr(stages, "KEPT_SNAPSHOTS", 1)  # the state's snapshot expires
    run(spark, root, "s1", feed_of(spark, [(50, 13, 50)]), pages, outlets)
    assert counted(outlets) == one_scan(outlets)
    more = outlets_of(spark, ["s1.example.com"])
    run(spark, root, "t1", feed_of(spark, [(80, 14, 80)]), pages, more)
    assert counted(more) == one_scan(more)
