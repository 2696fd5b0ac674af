"""Nulls in any column, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math

import public_tokenizers
import pytest

import corpus_pipeline
from coverlens.llm import ann, bpe, fingerprint, mixing, near_dedup, quality, sharding, suffix_dedup, toxicity, url_filter
from tests.llm.data import ALL_KEYS, LONG, edge_docs, edge_labels, empty_docs, long_to_keys, prose

EMPTY = hashlib.sha256(b"").hexdigest()
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

PER_DOCUMENT = {
    "quality": lambda docs, labels: quality.score_quality(docs, labels),
    "toxicity": lambda docs, labels: toxicity.score_toxicity(docs, labels),
    "mixing": lambda docs, labels: mixing.mix(docs),
    "near_dedup": lambda docs, labels: near_dedup.near_duplicates(docs),
    "sharding": lambda docs, labels: sharding.assign_shards(docs, limit=20_000),
    "suffix_dedup": lambda docs, labels: suffix_dedup.repeated_strings(docs),
    "bpe": lambda docs, labels: bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN),
    "fingerprint": lambda docs, labels: fingerprint.fingerprint_documents(docs),
}


@pytest.fixture(scope="module")
def results(spark):
    docs, labels = edge_docs(spark), edge_labels(spark)
    return {name: run(docs, labels).collect() for name, run in PER_DOCUMENT.items()}


def of(rows, key):
    return [r for r in rows if r["doc_id"] == key]


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_per_input_row(results, name):
    assert long_to_keys(results[name]) == ALL_KEYS


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_repeated_rows_agree(results, name):
    first, second = of(results[name], 6)
    if name != "fingerprint":  # there, the second of two equal rows is followed by another document
        assert first == second


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_empty_table(spark, name):
    assert PER_DOCUMENT[name](empty_docs(spark), edge_labels(spark)).collect() == []


@pytest.mark.parametrize("name", ["quality", "toxicity"])
def test_no_labels(spark, name):
    rows = PER_DOCUMENT[name](edge_docs(spark), edge_labels(spark).limit(0)).collect()
    assert len(rows) == len(ALL_KEYS) and all(0 <= r["score"] <= 1 for r in rows)


def test_scores_are_probabilities(results):
    for name in ("quality", "toxicity"):
        for r in results[name]:
            assert 0 <= r["score"] <= 1 and not math.isnan(r["score"]) and r["predicted"] == int(r["score"] >= 0.5)


def test_near_duplicates(results):
    rows = results["near_dedup"]
    assert [r["n_shingles"] for k in (1, 2, 3) for r in of(rows, k)] == [0, 0, 0]
    assert [r["component_id"] for k in (1, 2, 3, 4, 6, 7, 8, 12, 13) for r in of(rows, k)] == [1, 2, 3, 4, 6, 6, 6, 6, 12, 12]
    assert of(rows, 4)[0]["n_shingles"] == 1 and of(rows, 12)[0]["n_shingles"] == 1
    assert all(r["component_id"] is None and r["kept"] for r in of(rows, None))


def test_mixing(results):
    rows = results["mixing"]
    assert all(r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0) for r in rows)
    assert {r["size"] for k in (1, 2, 3) for r in of(rows, k)} == {0}
    assert sum(r["size"] for r in rows) == pytest.approx(sum({r["source_size"]: r["target"] for r in rows}.values()), rel=1e-9)


def test_shards_fit(results):
    rows = results["sharding"]
    assert of(rows, 2)[0]["n_bytes"] == 0
    assert {r["doc_id"] for r in rows if not r["fits"]} == {5} and of(rows, 5)[0]["n_bytes"] == len(LONG)


def test_suffix_dedup(results):
    rows = results["suffix_dedup"]
    assert [(r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in of(rows, 2)] == [(0, 0, EMPTY)]
    whole = len(prose(2, 300))
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"]) for r in of(rows, 7)] == [(whole, whole, 1)]
    assert of(rows, 8)[0]["kept_sha256"] == hashlib.sha256(b" tail").hexdigest()
    assert of(rows, 11)[0]["n_removed"] == 5000  # a string that repeats within one text


def test_bpe(results):
    rows = results["bpe"]
    assert [(r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in of(rows, 2)] == [(0, EMPTY, EMPTY)]
    assert of(rows, 5)[0]["decoded_sha256"] == hashlib.sha256(LONG.encode()).hexdigest()


def test_equal_texts_have_equal_fingerprints(results):
    rows = results["fingerprint"]
    assert of(rows, 12)[0]["fingerprint"] == of(rows, 13)[0]["fingerprint"] != ""
    assert of(rows, 1)[0]["fingerprint"] == of(rows, 2)[0]["fingerprint"] == ""
    assert of(rows, 6)[0]["near_next"] == 1.0 or of(rows, 6)[1]["near_next"] == 1.0


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://X.Example.NET/en/1?q=/a://b", "https://example.com/de/x#y",
            "https://a.org/fr/", "https://example.net", "http://org/fr/a", "x" * 3000 + "://h.net/" + "p" * 3000]
    pages = spark.createDataFrame([(i, u, "h", "z", "w") for i, u in enumerate(urls)],
                                  "page_id long, url string, host string, features string, key string")
    model = url_filter.fit(url_filter.labelled_urls(spark))
    rows = {r["page_id"]: r for r in url_filter.judge_urls(pages, model).collect()}
    assert [(rows[i]["host"], rows[i]["path"], rows[i]["rule"]) for i in range(4)] == [("", "", None)] * 4
    assert (rows[4]["host"], rows[4]["path"], rows[4]["rule"], rows[4]["verdict"]) == (
        "x.example.net", "/en/1", "example.net/en/", "allow")
    assert [rows[i]["verdict"] for i in (5, 6, 8)] == ["block", "allow", "allow"]
    assert rows[7]["rule"] is None and rows[9]["rule"] == "net/"
    assert url_filter.judge_urls(pages.limit(0), model).collect() == []


def test_vectors(spark):
    inf, nan = float("inf"), float("nan")
    vectors = [None, [], [0.0, 0.0], [1.0, None], [1.0, nan], [inf, 1.0], [1.0], [1.0, 2.0], [1.0, 2.0], [2.0, 1.0], [-1.0, 0.5]]
    rows = [(i, v, i, "c") for i, v in enumerate(vectors)] + [(20, [3.0, 1.0], 0, "c"), (20, [3.0, 1.0], 0, "c"), (None, [1.0, 1.0], 0, "c")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.nearest_neighbours(frame).orderBy("rank").collect()]
    assert got == [(20, 1, 9, 7.0), (20, 2, 7, 5.0), (20, 3, 8, 5.0), (20, 4, 10, -2.5)]
    assert ann.nearest_neighbours(frame.limit(0)).collect() == []


def test_pipeline_stages(spark, tmp_path):
    edge_labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (edge_docs(spark), empty_docs(spark)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == columns, name
            docs.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count()
