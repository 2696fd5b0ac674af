"""The paged feed: chains of pages, pages that are missing, tokens that come back, streams that resume."""

import json
import os

import pytest
from pyspark.sql import functions as F

from coverlens import schemas as S
from coverlens.session import work_path
from coverlens.sources import files, landing, paged
from coverlens.streaming import incremental


def land(path, token, following, ids, extra=()):
    folder = f"{path}/page={token}"
    os.makedirs(folder)
    rows = [json.dumps({"id": i, "publish_date": "2024-03-01", "title": f"té {i}", "url": f"u{i}", "more": 1}) for i in ids]
    with open(f"{folder}/part-0.txt", "w", encoding="utf-8") as out:
        out.write("\n".join([json.dumps({"next": following}), *rows, *extra]) + "\n")


def ids(frame):
    return sorted(r["id"] for r in frame.collect() if r["id"])


@pytest.fixture
def path(spark):
    return work_path(spark, "pages")


def test_same_rows_as_the_files(spark, path):
    land(path, "first", "b", ["1", "2"])
    land(path, "b", "c", [])
    land(path, "c", None, [str(i) for i in range(10, 6000)])
    land(path, "unnamed", None, ["99999"])  # no page leads here
    got = paged.read_pages(spark, path)
    plain = spark.read.schema(S.FEED).json([f"{path}/page={t}" for t in ("first", "b", "c")]).filter("id IS NOT NULL")
    assert got.schema == S.FEED and got.rdd.getNumPartitions() == 3
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    assert landing.in_window(got, None, None).count() == 5992
    assert ids(paged.read_pages(spark, f"file:{path}", first="b")) == sorted(str(i) for i in range(10, 6000))


def test_missing_pages_and_broken_lines(spark, path):
    assert paged.read_pages(spark, path).count() == 0
    land(path, "first", "b", ["1"], ["not json", "[1]", "", '{"id": 7, "title": null}'])
    land(path, "c", None, ["3"])
    rows = paged.read_pages(spark, path).collect()
    assert [r["id"] for r in rows] == ["1", None, None, "7"]  # nothing is lost: rows without an id are for the rejects
    land(path, "b", "c", ["2"])
    assert ids(paged.read_pages(spark, path)) == ["1", "2", "3", "7"]


def test_a_token_that_comes_back_ends_the_chain(spark, path):
    land(path, "first", "b", ["1"])
    land(path, "b", "first", ["2"])
    assert ids(paged.read_pages(spark, path)) == ["1", "2"]
    land(path, "self", "self", ["3"])
    assert ids(paged.read_pages(spark, path, first="self")) == ["3"]


@pytest.mark.parametrize("per_batch", [None, 1])
def test_a_stream_resumes_at_its_token(spark, path, per_batch):
    root = work_path(spark, "stream")

    def run():
        stream = paged.stream_pages(spark, path, pages_per_batch=per_batch)
        query = stream.writeStream.foreachBatch(lambda rows, i: rows.write.mode("append").parquet(f"{root}/out"))
        query = query.option("checkpointLocation", f"{root}/checkpoint").start()
        query.processAllAvailable()
        query.stop()
        return ids(landing.read_table(spark, f"{root}/out", S.FEED))

    land(path, "first", "b", ["1", "2"])
    land(path, "b", "c", ["3"])
    assert run() == ["1", "2", "3"]
    assert run() == ["1", "2", "3"]          # nothing new, nothing twice
    land(path, "d", "b", ["5"])              # leads back to a page that was read
    assert run() == ["1", "2", "3"]          # c is still missing
    land(path, "c", "d", ["4"])
    assert run() == ["1", "2", "3", "4", "5"]


def test_stream_append_over_pages(spark, path):
    root = work_path(spark, "append")
    for i, following in (("first", "b"), ("b", "c")):
        land(path, i, following, ["1", "2", i])
    append = lambda: incremental.stream_append(paged.stream_pages(spark, path), f"{root}/feed", f"{root}/checkpoint", S.FEED, "id").awaitTermination()
    append()
    land(path, "c", None, ["2", "9"])
    append()
    stored = landing.read_table(spark, f"{root}/feed", S.FEED)
    assert ids(stored) == ["1", "2", "9", "b", "first"] and stored.filter(F.col("title").startswith("té")).count() == 5
    assert files.folders(spark, f"{root}/feed")
