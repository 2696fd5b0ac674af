"""Small inputs that the tests of all operators share."""

import random

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "tu", "re", "san"]) for _ in range(rng.randint(1, 4))) for _ in range(words))


LONG = prose(1, 9000)
EDGE_ROWS = [
    (1, "", "en", "a"), (2, None, "en", "a"), (3, " \n\t ", None, "b"), (4, "one two", "en", None),
    (5, LONG, "en", "a"), (6, prose(2, 300), "de", "b"), (6, prose(2, 300), "de", "b"), (7, prose(2, 300), "de", "a"),
    (8, prose(2, 300) + " tail", "de", "c"), (9, prose(3, 5), "fr", None), (None, prose(4, 60), "fr", "c"),
    (None, None, None, None), (10, "A! B! C! \u00e9\u00e8 \U0001f600 x" * 40, "es", "c"), (11, "x" * 5000, "es", "c"),
    (12, "tie tie tie tie tie", "es", "c"), (13, "tie tie tie tie tie", "es", "b")]
# names that operators use inside
CLASHING = ["key", "n", "score", "size", "node", "bucket", "label", "stats", "found", "copies", "range", "ord", "target", "kept"]


def edge_docs(spark):
    docs = spark.createDataFrame(EDGE_ROWS, "doc_id long, text string, lang string, source string")
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).withColumns({c: F.lit("clash") for c in CLASHING})


def empty_docs(spark):
    return edge_docs(spark).limit(0)


def edge_labels(spark):
    rows = [(i, i % 2, i % 2, "x") for i in range(1, 12)] + [(6, 0, 0, "x"), (99, 1, 1, "x"), (None, 1, 1, "x"), (12, None, None, "x")]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, key string")


def long_to_keys(rows):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows)


ALL_KEYS = sorted((r[0] is None, r[0] or 0) for r in EDGE_ROWS)
