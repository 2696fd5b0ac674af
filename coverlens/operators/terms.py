"""Texts that hold any of a table of terms, of any size.

``text.search_terms`` is one ``contains`` per term and part of the plan; here the terms are rows.  A term
is a string that may start and end inside of words and may have white space inside, as with
``contains``.  Every task has a scanner of the terms and reads its texts once.  For more terms than a
task should hold, the words of all texts are reduced to the vocabulary; parts of these words meet parts
of the terms in an equality join, and only longer terms are looked up in the text once more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlens.operators.scanner import Scanner
from coverlens.session import small_batches

KEYS = 100_000  # at most so many keys that occur again are sent to every task
ANCHOR = 32  # characters of a term's longest word that are joined on
SMALL = 8 * 1024 * 1024  # terms of at most so many characters, ROW more for each, are sent to every task
ROW = 64
CHUNK = 256  # longer words are looked at in overlapping pieces, so that no row holds all parts of a long one

_SPACE = r"[ \t\r\n\f]+"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def anchored(terms: DataFrame, term: str = "term") -> DataFrame:
    """(term, anchor, exact): distinct lower-cased terms and the start of their longest word, the first of equals.

    ``exact``: the anchor is the whole term.  Terms that are NULL or white space only match nothing and are left out.
    """
    lowered = terms.select(F.lower(F.col(term)).alias("term")).distinct()
    longest = F.array_max(F.transform(_words(F.col("term")), lambda w, i: F.struct(F.length(w).alias("n"), (-i).alias("i"), w.alias("w"))))
    found = lowered.withColumn("anchor", F.substring(longest["w"], 1, ANCHOR)).filter(F.col("anchor") != "")
    return found.withColumn("exact", F.col("anchor") == F.col("term"))


def _pieces(word: Column) -> Column:
    """A word as pieces of CHUNK characters and the ANCHOR - 1 that follow; most words are one piece."""
    chunks = F.split(word, rf"(?s)(?<=\G.{{{CHUNK}}})")
    joined = lambda c, after: F.concat(c, F.substring(F.coalesce(after, F.lit("")), 1, ANCHOR - 1))
    # zip_with, as an array named inside of a lambda would be made again for every element
    return F.when(F.length(word) <= CHUNK, F.array(word)).otherwise(F.zip_with(chunks, F.slice(chunks, 2, F.size(chunks)), joined))


def _parts(piece: Column, lengths: list[int]) -> Column:
    """All parts of a piece that have one of the lengths."""
    of = lambda n: F.when(F.length(piece) >= n, F.transform(
        F.sequence(F.lit(1), F.length(piece) - (n - 1)), lambda at: F.substring(piece, at, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.flatten(F.array(*[of(n) for n in lengths])))


def term_hits(texts: DataFrame, terms: DataFrame, key: str, text: str = "text", term: str = "term") -> DataFrame:
    """Distinct (key, term) of every text that holds the lower-cased term, case-insensitive as ``contains`` on lower case.

    Rows without key or text hit nothing.  A key that occurs with several texts hits what any of them holds.

    Plan: terms of at most SMALL characters are looked for by a scanner in every task, texts are not shuffled; more
    terms meet the texts in joins (``_joined``).
    """
    wanted = anchored(terms, term)
    # at most ANCHOR rows, whatever the number of terms
    sizes = wanted.groupBy(F.length("anchor").alias("n")).agg(F.sum(F.length("term")).alias("size"), F.count("*").alias("terms")).collect()
    lengths = sorted(r["n"] for r in sizes)
    given = texts.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("_key"), F.lower(F.col(text)).alias("_text"))
    if not lengths:
        return given.select(F.col("_key").alias(key), F.lit("").alias("term")).limit(0)
    hits = None
    small = sum(r["size"] + ROW * r["terms"] for r in sizes) <= SMALL
    if small:
        wanted = F.broadcast(wanted)
        hits = _scanned(given, wanted, texts.select(F.col(key).alias("_key")).filter(F.col("_key").isNotNull()))
    if hits is None:
        hits = _joined(given, wanted, lengths)
    return hits.select(F.col("_key").alias(key), "term")


def _scanned(given: DataFrame, wanted: DataFrame, keys: DataFrame) -> DataFrame | None:
    """Hits by a scanner, one row of term numbers per text; None if the terms do not fit one.

    A term's number is its hash, so the plan's own terms give it back.  Pairs of key and term are shuffled only for keys that
    occur again, found by a count of the keys before.
    """
    numbered = wanted.select("term", F.xxhash64("term").alias("_number"))
    rows = numbered.select(F.col("term").cast("binary").alias("term"), "_number").collect()
    if len({r["_number"] for r in rows}) < len(rows):
        return None
    scanner = Scanner.of([bytes(r["term"]) for r in rows], [r["_number"] for r in rows])
    if scanner is None:
        return None
    spark = given.sparkSession
    small_batches(spark)
    numbers = _numbers(spark.sparkContext.broadcast(scanner))

    def hits(some: DataFrame) -> DataFrame:
        found = some.select("_key", F.explode(numbers(F.col("_text").cast("binary"))).alias("_number"))
        return found.join(F.broadcast(numbered), "_number").select("_key", "term")

    again = keys.groupBy("_key").agg(F.count("*").alias("n")).filter("n > 1").select("_key")
    n = again.limit(KEYS + 1).count()
    if not n:
        return hits(given)
    if n > KEYS:
        return hits(given).distinct()
    again = F.broadcast(again)
    return hits(given.join(again, "_key", "left_anti")).unionByName(hits(given.join(again, "_key", "left_semi")).distinct())


def _numbers(scanner):
    """An Arrow function: numbers of the terms that a text holds; ``scanner`` is a broadcast."""
    @F.arrow_udf("array<bigint>")
    def numbers(texts: pa.Array) -> pa.Array:
        if not len(texts):
            return pa.array([], type=pa.list_(pa.int64()))
        width = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, dtype=width, count=len(texts) + 1, offset=texts.offset * np.dtype(width).itemsize).astype(np.int64)
        found, held = scanner.value.hits(np.frombuffer(data or b"", dtype=np.uint8), at)
        return pa.ListArray.from_arrays(pa.array(found.astype(np.int32)), pa.array(held))
    return numbers


def _joined(given: DataFrame, wanted: DataFrame, lengths: list[int]) -> DataFrame:
    """Hits by joins, whatever the number of terms.

    Words per text (distinct), distinct pieces of words (map-side), their parts of the at most 32
    lengths that anchors have, an equality join to the anchors, back to the texts on the piece.  What goes back is one
    string of anchors per word, and they meet in one row per key; terms come in only then, beside the text, so that pairs of
    text and term are not shuffled unless the terms are over SMALL characters.  No pair is formed that does not
    share an anchor.  A frequent word is a skewed key of a plain join, which AQE splits.
    """
    pieces = F.array_distinct(F.flatten(F.transform(F.array_distinct(_words(F.col("_text"))), _pieces)))
    postings = given.select("_key", F.explode(pieces).alias("piece")).filter(F.length("piece") >= lengths[0])
    vocabulary = postings.select("piece").distinct()
    parts = vocabulary.select("piece", F.explode(_parts(F.col("piece"), lengths)).alias("anchor"))
    # anchors hold no white space; a piece has at most its length times ANCHOR of them
    met = (parts.join(wanted.select("anchor").distinct(), "anchor").groupBy("piece")
           .agg(F.array_join(F.sort_array(F.collect_list("anchor")), " ").alias("anchors")))
    held = postings.join(met, "piece").groupBy("_key").agg(F.collect_set("anchors").alias("anchors"))
    found = F.array_distinct(F.split(F.array_join("anchors", " "), " "))
    candidates = held.select("_key", F.explode(found).alias("anchor")).join(wanted, "anchor").select("_key", "term", "exact")
    hits = candidates.join(given, "_key").filter(F.col("exact") | F.contains("_text", F.col("term"))).select("_key", "term")
    # a key with several texts may repeat
    return hits.distinct()


def holding_terms(texts: DataFrame, terms: DataFrame, key: str, text: str = "text", term: str = "term") -> DataFrame:
    """The rows of ``texts`` whose key has any hit: the feed query over a terms table.  ``key`` identifies the rows."""
    return texts.join(term_hits(texts, terms, key, text, term).select(key).distinct(), key, "left_semi")
