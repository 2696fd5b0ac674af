"""Term tables against one ``contains`` per term."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from coverlens.functions import text
from coverlens.operators import scanner, terms

TEXTS = [(1, "The quick brown\nfox, 'there'."), (2, "Elle  est là"), (3, ""), (4, None), (5, "x" * 700 + "needle" + "y" * 700),
         (6, "a b c"), (7, "THERE WAS a Quick  Brown fox"), (8, " \t "), (None, "the"), (9, "one two"), (9, "three four"), (9, "one two"),
         (10, "ab" * 40 + " tail"), (11, "🙂🙂 " + "🙂" * 300 + "end")]
TERMS = ["there", "quick brown", "QUICK", "elle", "needle", "xneedley", "b", " b ", "", "  ", None, "brown\nfox", "one two", "two three",
         "three", "three", "ab" * 20, "ab" * 41, "abab tail", "est là", "🙂", "🙂end", "x" * 300, "nowhere at all", "brown fox"]


def frames(spark, texts=TEXTS, given=TERMS):
    docs = spark.createDataFrame(texts, "doc_id int, text string").withColumn("term", F.lit("clash")).withColumn("anchor", F.lit(1))
    return docs, spark.createDataFrame([(t,) for t in given], "term string").withColumn("piece", F.lit(0))


def plain(texts, given):
    known = {t.lower() for t in given if t and t.strip(" \t\r\n\f")}
    return sorted({(k, t) for k, v in texts if k is not None and v for t in known if t in v.lower()})


def test_equals_contains(spark):
    docs, given = frames(spark)
    got = [(r["doc_id"], r["term"]) for r in terms.term_hits(docs, given, "doc_id").collect()]
    assert sorted(got) == plain(TEXTS, TERMS)
    assert (5, "xneedley") in got and (5, "x" * 300) in got and (11, "🙂end") in got and (9, "two three") not in got
    held = terms.holding_terms(docs, given, "doc_id")
    assert held.columns == docs.columns
    assert sorted(r["doc_id"] for r in held.collect()) == [1, 2, 5, 6, 7, 9, 9, 9, 10, 11]


@pytest.mark.parametrize("small", [0, terms.SMALL])
def test_pairs_of_text_and_term_are_not_shuffled(spark, monkeypatch, small):
    """Terms of one frequent word each: the shuffles hold texts, words and anchors, not one row per text and term."""
    monkeypatch.setattr(terms, "SMALL", small)
    texts = [(i, f"the word{i % 7} the end of the text") for i in range(60)]
    given = [f"the x{i}" for i in range(300)] + ["the end", "d1 the", "nd", "ext", "Text"]
    docs, table = frames(spark, texts, given)
    frame = terms.term_hits(docs, table, "doc_id")
    assert sorted((r["doc_id"], r["term"]) for r in frame.collect()) == plain(texts, given)
    rows = max(exchanged(frame._jdf.queryExecution().executedPlan()))
    assert rows < 1500 or not small, rows  # 60 texts with 301 terms of "the" would be 18,060


def exchanged(plan):
    """Rows written by every exchange of a plan that was run."""
    name, found = plan.getClass().getSimpleName(), []
    if name == "AdaptiveSparkPlanExec":
        return exchanged(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return exchanged(plan.plan())
    if name == "ShuffleExchangeExec":
        found.append(plan.metrics().apply("shuffleRecordsWritten").value())
    below = plan.children()
    return found + [n for i in range(below.size()) for n in exchanged(below.apply(i))]


def test_the_same_as_the_ored_form(spark):
    sf = "/root/testdata/sf0.001/documents.parquet"
    docs = spark.read.parquet(sf).select("doc_id", "text")
    given = ["there", "elle", "on the", "er th", "ing of", "é", "aux.", ". le", "zzz"] + [f"{a}{b}" for a in "abcdefg" for b in "nrstu"] + [
        "the in", "of the", "que la", "et", "un", "tion en"]
    assert len(given) == 50
    ored = docs.filter(text.search_terms(F.col("text"), given)).select("doc_id")
    held = terms.holding_terms(docs, spark.createDataFrame([(t,) for t in given], "term string"), "doc_id").select("doc_id")
    assert sorted(held.collect()) == sorted(ored.collect()) and held.count() > 0


def test_ten_thousand_terms(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(4, 9))) for _ in range(3000)]
    texts = [(i, " ".join(rng.choice(words) for _ in range(80))) for i in range(120)]
    given = list({" ".join(rng.choice(words) for _ in range(rng.randint(1, 2))) for _ in range(5000)}
                 | {"".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(5000)})
    docs, table = frames(spark, texts, given)
    frame = terms.term_hits(docs, table, "doc_id")
    assert sorted((r["doc_id"], r["term"]) for r in frame.collect()) == plain(texts, given)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan


def test_empty_tables(spark):
    docs, given = frames(spark)
    assert terms.term_hits(*frames(spark, [], TERMS), "doc_id").count() == 0
    assert terms.term_hits(*frames(spark, TEXTS, []), "doc_id").columns == ["doc_id", "term"]
    assert terms.holding_terms(*frames(spark, TEXTS, ["", None]), "doc_id").count() == 0


@pytest.mark.parametrize("again", [0, 3])
def test_words_of_texts_are_not_shuffled(spark, again):
    """Small terms are looked for where the texts are; only keys, and the pairs of keys that occur again, are shuffled."""
    texts = [(i, " ".join(f"w{i}x{j}" for j in range(50))) for i in range(80)] + [(i, f"other w{i}") for i in range(again)]
    given = ["x1", "x2", "x3", "w7x4 w7x5", "other"]
    docs, table = frames(spark, texts, given)
    frame = terms.term_hits(docs, table, "doc_id")
    assert sorted((r["doc_id"], r["term"]) for r in frame.collect()) == plain(texts, given)
    rows = max(exchanged(frame._jdf.queryExecution().executedPlan()))
    assert rows <= len(texts), rows  # 80 texts have 4000 words


@pytest.mark.parametrize("limits", [{}, {"KEYS": 0}, {"SMALL": 0}, {"ENTRIES": 10}])
def test_every_way_finds_the_same(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(scanner if name == "ENTRIES" else terms, name, value)
    texts = TEXTS + [(12, "one two"), (12, None), (None, "one two"), (13, "É" * 90 + "one  two")]
    given = TERMS + ["é" * 40, "é" * 89 + "o", "x" * 65, "x" * 65 + "needle", "e t"]
    got = [(r["doc_id"], r["term"]) for r in terms.term_hits(*frames(spark, texts, given), "doc_id").collect()]
    assert sorted(got) == plain(texts, given)


@pytest.mark.parametrize("limits", [(1024, 4096, 1 << 24), (16, 7, 50), (70, 5, 1000)])
def test_scanner_equals_in(monkeypatch, limits):
    """Bytes of any value, terms within terms, over CUT bytes and over the ends of pieces, texts without bytes."""
    for name, value in zip(["PIECE", "LANES", "CELLS"], limits, strict=True):
        monkeypatch.setattr(scanner, name, value)
    rng = random.Random(5)
    for trial in range(12):
        letters = [b"ab", "abc é".encode(), bytes(range(256))][trial % 3]
        piece = lambda n: bytes(rng.choice(letters) for _ in range(n))
        given = list({piece(rng.choice([1, 2, 3, 5, 60, 64, 65, 70, 90])) for _ in range(rng.choice([1, 5, 50]))})
        texts = [b"".join(rng.choice([rng.choice(given), piece(1)]) for _ in range(rng.choice([0, 1, 30]))) for _ in range(rng.randint(0, 12))]
        ids = [7 * i for i in range(len(given))]
        at, held = scanner.Scanner.of(given, ids).hits(np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0] + [len(t) for t in texts]))
        got = [sorted(held[at[i]:at[i + 1]].tolist()) for i in range(len(texts))]
        assert got == [[n for n, t in zip(ids, given, strict=True) if t in text] for text in texts]
