"""Learned abbreviations: counts, the test, and boundaries."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from coverlens.functions import text
from coverlens.operators import abbreviations


def frame(spark, rows):
    return spark.createDataFrame([(t,) for t in rows], "text string").withColumn("word", F.lit("clash"))


def test_counts(spark):
    rows = ["The abt. was here. Then the abt. (new) left, abt! See", "(abt. Then", None, "", " . .. x.y. 5", "abt."]
    got = {r["word"]: (r["n_dot"], r["n_small"], r["n_plain"]) for r in abbreviations.count_words(frame(spark, rows)).collect()}
    assert got == {"the": (0, 0, 2), "abt": (4, 2, 1), "was": (0, 0, 1), "here": (1, 0, 0), "then": (0, 0, 2), "new": (0, 0, 1),
                   "left": (0, 0, 1), "see": (0, 0, 1), "x.y": (1, 1, 0)}


def test_log_likelihood(spark):
    counts = [("abt", 20, 19, 1), ("end", 300, 3, 900), ("stop", 400, 2, 100), ("all", 9, 9, 0), ("rare", 1, 1, 0), ("half", 40, 39, 60), ("none", 5, 0, 0)]
    table = spark.createDataFrame(counts, "word string, n_dot long, n_small long, n_plain long")
    p = sum(c[2] for c in counts) / sum(c[1] for c in counts)
    bits = lambda k, n, q: (k * math.log(q) if k else 0) + ((n - k) * math.log(1 - q) if n > k else 0)
    want = {w: 2 * (bits(k, n, k / n) - bits(k, n, p)) for w, n, k, plain in counts if k and n >= plain and k / n > p}
    got = {r["word"]: r["score"] for r in abbreviations.learn(table).collect()}
    assert got == {w: pytest.approx(s) for w, s in want.items() if s >= abbreviations.LEAST_SCORE}
    assert set(got) == {"abt", "all"}
    assert {r["word"] for r in abbreviations.learn(table, least_score=1, least_dotted=0).collect()} == {"abt", "all", "rare", "half"}
    assert abbreviations.learn(table.filter("n_dot < 0")).count() == 0


def test_boundaries(column):
    given = ["He saw abt. ten men. They left abt. Noon came.", "Size abt.\n5 miles.", "Size abt.\n\nfive miles.", "abt. (ten) left", "Gabt. ten",
             "No x.abt. ten", None, "", "See U.S. abt. ten.\nMr. Lee came abt. 5 p.m. today!"]
    got = column(given, F.array_join(abbreviations.sentences(F.col("v"), ["abt"]), "|"))
    assert got == ["He saw abt. ten men.|They left abt.|Noon came.", "Size abt.\n5 miles.", "Size abt.|five miles.", "abt. (ten) left", "Gabt.|ten",
                   "No x.abt.|ten", None, "", "See U.S. abt. ten.|Mr. Lee came abt. 5 p.m. today!"]
    assert column(given, abbreviations.sentences(F.col("v"), [])) == column(given, text.sentences(F.col("v")))
    assert column(given, abbreviations.sentences(F.col("v"), ["zzz"])) == column(given, text.sentences(F.col("v")))


def test_planted_abbreviations_are_found(spark):
    """Every planted one is learned; every boundary of the corpus stays and none is added."""
    rng = random.Random(5)
    shorts, words = ["abt", "cirk", "z.bsp", "hptm"], ["river", "stone", "walks", "green", "lamp", "over", "under", "seven"]
    texts, ends = [], 0
    for _ in range(200):
        made = []
        for _ in range(rng.randint(2, 6)):
            body = [rng.choice(words) for _ in range(8)]
            if rng.random() < 0.3:
                body.insert(rng.randint(1, 6), rng.choice(shorts) + ".")
            made.append(" ".join(body).capitalize() + ".")
        ends += len(made)
        texts.append(" ".join(made))
    given = frame(spark, texts)
    words = abbreviations.rule_list(abbreviations.learn(abbreviations.count_words(given)))
    assert words == sorted(shorts)
    split = lambda c: given.select(F.sum(F.size(c))).first()[0]
    n_planted = sum(len(re.findall(r"\b(?:abt|cirk|z\.bsp|hptm)\. ", t)) for t in texts)
    assert split(text.sentences(F.col("text"))) == ends + n_planted  # all of them split before
    assert split(abbreviations.sentences(F.col("text"), words)) == ends


def test_a_longer_list_is_refused(spark, monkeypatch):
    monkeypatch.setattr(abbreviations, "MAX_RULES", 2)
    with pytest.raises(ValueError):
        abbreviations.rule_list(spark.createDataFrame([("a",), ("b",), ("c",)], "word string"))
