"""Threshold-scaled sketches: every shingle hash below a fixed fraction of the hash range is kept.

Two sketches are comparable whatever the sizes of their documents, and the sketch of
a union is made from the sketches alone.  All steps are column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverlens.llm.common import SHINGLE_WORDS, bound, words_of

BELOW = "2"         # hashes are hex strings; those below this prefix, an eighth of all, are kept
HASH_DIGITS = 14
RANGE_ROWS = 1_000    # rows are put in order by ranges of about this many ...
MAX_RANGES = 50_000   # ... or, in very large tables, in this many larger ones


def shingle_hashes(text: Column) -> Column:
    """Hashes of all runs of five words; with fewer words, of the whole sequence; none without words."""
    def of(words: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(words) - (SHINGLE_WORDS - 1), F.lit(1))),
            lambda i: F.substring(F.md5(F.array_join(F.slice(words, i, SHINGLE_WORDS), " ")), 1, HASH_DIGITS))
        return F.when(F.size(words) == 0, F.array().cast("array<string>")).otherwise(runs)

    return bound(words_of(text), of)


def sketch(hashes: Column) -> Column:
    """The kept hashes as sorted longs; the smallest one if none lies below the fraction."""
    def of(hashes: Column) -> Column:
        kept = F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h < F.lit(BELOW))))
        smallest = F.when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(hashes)
        return bound(kept, lambda k: F.when(F.size(k) > 0, k).otherwise(smallest))

    return F.transform(bound(hashes, of), lambda h: F.conv(h, 16, 10).cast("long"))


def merge(a: Column, b: Column) -> Column:
    """The sketch of two documents' shingles together."""
    limit = int(BELOW.ljust(HASH_DIGITS, "0"), 16)
    return bound(F.array_sort(F.array_union(a, b)), lambda both: bound(
        F.filter(both, lambda h: h < limit), lambda kept: F.when(F.size(kept) > 0, kept).otherwise(F.slice(both, 1, 1))))


def as_text(sketch: Column) -> Column:
    """A sketch as one string of hex digits, HASH_DIGITS a hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), HASH_DIGITS, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles among all of both (Jaccard); two empty sketches are alike."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has too; an empty sketch is contained in any."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def _position(key: Column, tie: Column, cuts: list[int]) -> Column:
    """The number of ``cuts`` below the key, by bisection; rows without a key get 256 lower ranges by their tie."""
    steps = [1 << i for i in reversed(range(max(1, len(cuts)).bit_length()))]
    known = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when(F.coalesce(F.get(known, at + step - 1) < key, F.lit(False)), at + step).otherwise(at))
    return F.when(key.isNull(), -1 - F.conv(F.substring(tie, 1, 2), 16, 10).cast("int")).otherwise(found)


def with_next(rows: DataFrame, payload) -> DataFrame:
    """Adds ``next``, the payload of the row that follows in descending key order (ties by ``tie``);
    the last row is followed by the first.

    ``rows`` has key, tie and what ``payload(rows)`` adds.  Rows are dealt into quantile
    ranges of the key, as many as the table needs (at most MAX_RANGES), whatever the ids
    look like.  Only the first row of each range is copied, to the end of the range before it.
    """
    keys = rows.select("key", "tie")
    n = rows.select("key").count()
    ranges = int(min(MAX_RANGES, n // RANGE_ROWS))
    cuts: list[int] = []
    if ranges > 1:
        at = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
        cuts = sorted(set(keys.agg(F.percentile_approx("key", at, F.lit(10 * ranges))).first()[0] or []))
    place = _position(F.col("key"), F.col("tie"), cuts).alias("range")
    first = F.struct(F.col("key").isNull(), -F.col("key"), F.col("tie"))
    heads = keys.select("*", place).groupBy("range").agg(
        F.min_by("key", first).alias("key"), F.min_by("tie", first).alias("tie"))
    # at most MAX_RANGES + 256 rows: each range's first row goes to the range before it
    downwards = Window.orderBy(F.col("range").desc())
    heads = heads.select("key", "tie", F.coalesce(
        F.lag("range").over(downwards), F.min("range").over(Window.partitionBy())).alias("range"))
    heads = F.broadcast(heads.withColumnsRenamed({"key": "head_key", "tie": "head_tie"}))
    copies = rows.join(heads, F.col("key").eqNullSafe(F.col("head_key")) & (F.col("tie") == F.col("head_tie")))
    copies = copies.drop("head_key", "head_tie").dropDuplicates(["range"])
    every = (payload(rows.withColumn("range", place)).withColumn("copy", F.lit(0))
             .unionByName(payload(copies).withColumn("copy", F.lit(1))))
    inside = Window.partitionBy("range").orderBy("copy", F.col("key").desc_nulls_last(), "tie")
    return every.withColumn("next", F.lead(F.struct("text", "sketch")).over(inside)).filter("copy = 0")


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last third (rounded down, in code points) replaced by as many
    first code points of the next document in descending key order.  A null text counts
    as empty; it has an empty fingerprint, alike only to another empty one.  Rows without a
    key come last, rows of equal key are ordered by the md5 of their text; equal rows follow
    each other.  An empty table has no rows.  Other columns of ``docs`` play no part.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.md5(F.col("text").cast("binary")))
    linked = with_next(rows, lambda frame: frame.withColumn("sketch", sketch(shingle_hashes(F.col("text")))))
    n, cut = F.char_length("text"), F.floor(F.char_length("text") / 3).cast("int")
    edited = linked.select(
        "key", "sketch", F.col("next.sketch").alias("next_sketch"), n.cast("long").alias("n_chars"),
        F.concat(F.left("text", n - cut), F.left("next.text", cut)).alias("edited"))
    edited = edited.withColumn("edited_sketch", sketch(shingle_hashes(F.col("edited"))))
    return edited.select(
        F.col("key").alias(key), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


def _words_sql(text: str) -> str:
    return f"regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')"


def _hashes_sql(words: str) -> str:
    return (f"CASE WHEN len({words}) = 0 THEN [] ELSE [substr(md5(array_to_string({words}[i:i + {SHINGLE_WORDS - 1}], ' ')), "
            f"1, {HASH_DIGITS}) for i in range(1, greatest(len({words}) - {SHINGLE_WORDS - 2}, 2))] END")


def oracle_sql() -> str:
    kept = lambda h: (f"CASE WHEN len([x for x in {h} if x < '{BELOW}']) > 0 "
                      f"THEN list_sort(list_distinct([x for x in {h} if x < '{BELOW}'])) "
                      f"WHEN len({h}) > 0 THEN [list_min({h})] ELSE [] END")
    like = lambda a, b: (f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0 ELSE len(list_intersect({a}, {b}))::DOUBLE / "
                         f"len(list_distinct(list_concat({a}, {b}))) END")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
o AS (
  SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text
  FROM d WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, md5(text) ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (
  SELECT *, length(text) AS n, left(text, length(text) - length(text) // 3) || left(next_text, length(text) // 3) AS edited
  FROM o),
w AS MATERIALIZED (SELECT *, {_words_sql('text')} AS w1, {_words_sql('edited')} AS w2, {_words_sql('next_text')} AS w3 FROM e),
h AS MATERIALIZED (SELECT *, {_hashes_sql('w1')} AS h1, {_hashes_sql('w2')} AS h2, {_hashes_sql('w3')} AS h3 FROM w),
s AS (SELECT doc_id, n, edited, {kept('h1')} AS s1, {kept('h2')} AS s2, {kept('h3')} AS s3 FROM h)
SELECT doc_id, n::BIGINT AS n_chars, sha256(edited) AS edited_sha256,
       array_to_string(s1, '') AS fingerprint, array_to_string(s2, '') AS edited_fingerprint,
       {like('s1', 's2')} AS near_edited, {like('s1', 's3')} AS near_next
FROM s"""
