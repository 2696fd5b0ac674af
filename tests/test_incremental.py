"""Writers, windows, streams and the staged run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from coverlens import schemas as S
from coverlens.plans import stages
from coverlens.session import work_path
from coverlens.sources import dims, landing, writers
from coverlens.streaming import incremental

RUN = dt.datetime(2024, 6, 1)


def keyed(spark, ids, note="n"):
    return spark.createDataFrame([(str(i), note) for i in ids], "id string, note string")


def test_append_new(spark):
    path = work_path(spark, "t")
    schema = keyed(spark, [1]).schema
    append = lambda rows, batch: writers.append_new(spark, rows, path, schema, "id", batch).count()
    assert append(keyed(spark, list(range(100)) + [5, 5, 7]), "b1") == 100       # duplicates inside the batch
    assert append(keyed(spark, range(50, 150)), "b2") == 50                        # overlap with what is stored
    assert append(keyed(spark, range(50, 150)), "b2") == 50                        # the same batch again
    assert append(keyed(spark, []), "b3") == 0
    assert append(keyed(spark, range(150)), "b4") == 0
    stored = spark.read.parquet(path)
    assert stored.count() == stored.select("id").distinct().count() == 150
    with pytest.raises(ValueError):
        append(keyed(spark, [1]), "4")


def test_append_by_name_and_deterministic_duplicate(spark):
    path, schema = work_path(spark, "t"), keyed(spark, [1]).schema
    swapped = keyed(spark, [1]).select("note", "id")
    rows = writers.append_new(spark, swapped, path, schema, "id", "b1")
    assert tuple(rows.first()) == ("1", "n")
    twice = keyed(spark, [2], "x").unionByName(keyed(spark, [2], "a"))
    kept = writers.append_new(spark, twice, path, schema, "id", "b2", [F.col("note")])
    assert [tuple(r) for r in kept.collect()] == [("2", "a")]


def test_a_half_written_batch_is_replaced(spark):
    path, schema = work_path(spark, "t"), keyed(spark, [1]).schema
    keyed(spark, [1, 2]).write.parquet(f"{path}/batch=b1")  # what a failed attempt left
    writers.append_new(spark, keyed(spark, [1, 2, 3]), path, schema, "id", "b1")
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == ["1", "2", "3"]


def test_full_refresh_switches_versions(spark):
    path = work_path(spark, "t")
    assert writers.full_refresh(keyed(spark, [1]), path, "v1").count() == 1
    assert writers.full_refresh(keyed(spark, [1, 2]), path, "v2").count() == 2
    keyed(spark, [1, 2, 3]).write.parquet(f"{path}/data/v3")  # written, but never announced
    assert writers.current(spark, path).count() == 2


TRICKY = [("1", 'say "hi", ok'), ("2", "two\nlines"), ("3", "  edge blanks  "), ("4", "back\\slash"), ("5", ""), ("6", None),
          ("7", "a,b\r\nc"), ("8", "'single'"), ("9", '"'), ("10", "tab\tend\t"), ("11", "é“”")]


@pytest.mark.parametrize("write", [writers.write_csv, writers.write_csv_gzip])
def test_csv_round_trip(spark, write):
    path = work_path(spark, "csv")
    df = spark.createDataFrame(TRICKY, "id string, text string")
    write(df, path)
    got = {r["id"]: r["text"] for r in writers.read_csv(spark, path, df.columns).collect()}
    assert got == {k: v or "" for k, v in TRICKY}


def test_export_manifest_and_nested(spark):
    path = work_path(spark, "export")
    df = spark.range(5000).select(F.col("id").cast("string").alias("storyId"), F.lit("same text again").alias("text"), (F.col("id") % 3).alias("k"))
    writers.export(df, path)
    rows = {r["export"]: r for r in writers.export_manifest(spark, path).collect()}
    assert set(rows) == {"parquet", "csv", "csv_gzip"} and {r["n_rows"] for r in rows.values()} == {5000}
    assert rows["csv"]["pct_saved"] == 0.0 and rows["csv_gzip"]["n_bytes"] < rows["csv"]["n_bytes"]
    writers.write_nested(df, path + "/nested", ["k"])
    assert spark.read.parquet(path + "/nested").filter("k = 1").count() == df.filter("k = 1").count()


# --- windows --------------------------------------------------------------------------

def feed(spark, rows):
    return spark.createDataFrame([(i, d, f"t{i}", u, "en", "a.com") for i, d, u in rows], S.FEED)


def test_window(spark):
    stored = feed(spark, [("1", "2024-2-5", "u1"), ("2", "2024-11-01", "u2"), ("3", None, "u3"), ("4", "junk", "u4")])
    assert landing.next_window(stored, dt.date(2024, 12, 1)) == (dt.date(2024, 11, 1), dt.date(2024, 12, 1))
    empty = stored.limit(0)
    assert landing.next_window(empty, dt.date(2024, 12, 1), dt.date(2024, 1, 1)) == (dt.date(2024, 1, 1), dt.date(2024, 12, 1))
    with pytest.raises(ValueError):
        landing.next_window(empty, dt.date(2024, 12, 1))
    inside = landing.in_window(stored, dt.date(2024, 2, 5), dt.date(2024, 11, 1))
    assert {r["id"] for r in inside.collect()} == {"1", "2"}  # inclusive at both ends


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_read_feed(spark, fmt):
    path = work_path(spark, "landing")
    feed(spark, [("1", "2024-01-01", "u"), ("2", "2024-03-01", "u")]).write.format(fmt).save(path)
    assert [r["id"] for r in landing.read_feed(spark, path, dt.date(2024, 2, 1), fmt=fmt).collect()] == ["2"]


def test_read_table_before_anything_is_written(spark):
    assert landing.read_table(spark, work_path(spark, "none"), S.FEED).count() == 0


# --- streams --------------------------------------------------------------------------

def test_stream_append_resumes_and_ignores_overlap(spark):
    root, schema = work_path(spark, "stream"), keyed(spark, [1]).schema

    def run(target="target", checkpoint="checkpoint", **options):
        stream = incremental.stream_files(spark, f"{root}/in", schema, **options)
        incremental.stream_append(stream, f"{root}/{target}", f"{root}/{checkpoint}", schema, "id").awaitTermination()
        return spark.read.parquet(f"{root}/{target}")

    deliver = lambda ids: keyed(spark, ids).coalesce(1).write.mode("append").parquet(f"{root}/in")
    deliver([*range(100), 3, 3])
    assert run().count() == 100
    deliver(range(50, 150))
    got = run()
    assert got.count() == got.select("id").distinct().count() == 150
    assert run().count() == 150  # nothing new
    # a new checkpoint reads everything again: still no duplicate
    assert run(checkpoint="fresh").count() == 150
    # and it cannot overwrite what an earlier one landed from files that are gone by now
    later = work_path(spark, "later")
    keyed(spark, range(140, 160)).write.parquet(later)
    stream = incremental.stream_files(spark, later, schema)
    incremental.stream_append(stream, f"{root}/target", f"{root}/fresh2", schema, "id").awaitTermination()
    got = spark.read.parquet(f"{root}/target")
    assert got.count() == got.select("id").distinct().count() == 160
    assert all(r["batch"].count("None") == 0 for r in got.select("batch").distinct().collect())
    assert run("other", "other-cp", files_per_batch=1).count() == 150


def test_bounded_dedup(spark):
    root = work_path(spark, "dedup")
    rows = [(i, dt.datetime(2024, 1, 1, 0, i)) for i in range(30)]
    events = spark.createDataFrame(rows + rows[:10], "event_id int, ts timestamp")
    for _ in range(2):
        events.coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = incremental.stream_files(spark, f"{root}/in", events.schema)
        kept = incremental.bounded_dedup(stream, "event_id", "ts", "1 hour")
        incremental.stream_table(kept, f"{root}/out", f"{root}/cp").awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 30


# --- the staged run -------------------------------------------------------------------

PAGES = {
    "1": "<article><p>Acme rose. A much longer line about Acme.org today. End.</p></article>",
    "2": "<article><p>Nothing to see.</p></article>",
    "3": "",
    "5": "<article><p>Late acme page.</p></article>",
}


def run_once(spark, root, feed_rows, batch, today, pages=PAGES, **options):
    frame = spark.createDataFrame([("crawl" + k, "u" + k, v) for k, v in pages.items()], S.PAGE)
    staged = spark.createDataFrame([("A", "a.com", "Blog", "Ohio", "Left", True)], S.OUTLET_CSV)
    metrics = stages.run_stages(spark, root, feed(spark, feed_rows), frame, dims.outlet_dimension(spark, staged, RUN),
                                "acme", batch, today, run_ts=RUN, **options)
    return {(r["stage"], r["metric"]): r["value"] for r in metrics.collect()}


def test_staged_run(spark):
    root = work_path(spark, "run")
    rows = [("1", "2024-01-01", "u1"), ("2", "2024-01-02", "u2"), ("3", "2024-01-03", "u3"), ("4", "2024-01-03", "u4"),
            ("1", "2024-01-01", "u1")]
    got = run_once(spark, root, rows, "r1", dt.date(2024, 1, 3), start=dt.date(2024, 1, 1))
    assert got == {("feed", "n_fetched"): 5, ("feed", "n_inserted"): 4, ("feed", "n_rejected"): 0, ("feed", "n_skipped"): 1,
                   ("article", "n_ok"): 2, ("article", "n_failed"): 2,
                   ("sentence", "n_checked"): 2, ("sentence", "n_found"): 1,
                   ("story", "n_stories"): 4, ("export", "n_exported"): 4}
    sentences = {r["story_id"]: r["sentence"] for r in landing.read_table(spark, f"{root}/sentence", S.SENTENCE).collect()}
    assert sentences == {"1": "A much longer line about Acme.org today.", "2": ""}

    # the same batch again changes nothing
    assert run_once(spark, root, rows, "r1", dt.date(2024, 1, 3), start=dt.date(2024, 1, 1)) == got

    # the next run starts on the last stored day; failed pages are not tried again
    rows += [("5", "2024-01-05", "u1"), ("6", "2023-12-31", "u6")]
    second = run_once(spark, root, rows, "r2", dt.date(2024, 1, 6))
    assert (second[("feed", "n_fetched")], second[("feed", "n_inserted")]) == (3, 1)
    assert (second[("article", "n_ok")], second[("article", "n_failed")]) == (1, 0)
    assert second[("story", "n_stories")] == 4  # u1 again: one row per url
    with pytest.raises(ValueError):  # only the latest batch may be repeated
        run_once(spark, root, rows, "r1", dt.date(2024, 1, 6))
    third = run_once(spark, root, rows, "r3", dt.date(2024, 1, 6))
    assert (third[("feed", "n_inserted")], third[("article", "n_ok")], third[("sentence", "n_checked")]) == (0, 0, 0)

    # with retries a page that has arrived replaces its failure; one that fails again adds nothing
    fourth = run_once(spark, root, rows, "r4", dt.date(2024, 1, 6), {**PAGES, "4": "<p>Acme at last.</p>"}, retry_failed=True)
    assert (fourth[("article", "n_ok")], fourth[("article", "n_failed")]) == (1, 0)
    assert (fourth[("sentence", "n_checked")], fourth[("story", "n_stories")]) == (1, 4)
    stories = {r["url"]: r for r in stages.stories(spark, root).collect()}
    assert stories["u4"]["body"] == "Acme at last." and stories["u3"]["body"] == "" and stories["u1"]["feed_id"] == "1"
    exported = writers.read_csv(spark, f"{root}/export/r4/csv_gzip", spark.read.parquet(f"{root}/export/r4/parquet").columns)
    assert exported.count() == 4


def test_first_run_needs_a_start(spark):
    with pytest.raises(ValueError):
        run_once(spark, work_path(spark, "run"), [("1", "2024-01-01", "u1")], "r1", dt.date(2024, 1, 3))


def test_empty_feed(spark):
    got = run_once(spark, work_path(spark, "run"), [("1", "2020-01-01", "u1")], "r1", dt.date(2024, 1, 3), start=dt.date(2024, 1, 1))
    assert set(got.values()) == {0}


def test_work_path_is_below_the_shared_folder(spark):
    assert work_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_path(spark, "x") != work_path(spark, "x")
