"""Spelling variants: words one edit apart, found by dynamic programming along sorted word lists.

A sorted list is scanned once per query word.  Adjacent words share a prefix (their LCP), so the
rows of the edit matrix up to there are kept; a row needs only the three cells within one edit
of the diagonal.  Once a row holds nothing below two edits, all words with that prefix are skipped.

Two words one edit apart, the longer of m code points, agree in m // 2 code points at one of their ends.
Words therefore meet in lists of equal ends, not in one list of the whole vocabulary.  A list of more
than MEMBERS words is dealt anew by half of what its words may still differ in, at either end, down to
lists that leave a single place open.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlens.llm.common import written

LEAST_LENGTH, LEAST_COUNT = 5, 3
THINNED = 97             # a run whose hash this divides loses a code point
FACTOR = 2               # a form is at least so many times as frequent
MEMBERS = 400            # words in one sorted list
TASK_WORDS = 20_000      # words of all lists of a task, about
COUNTED_WORDS = 200_000  # words a task counts before it passes them on

_RUN = re.compile("[a-zÀ-ÿ]+")
_PAST = "\U0010FFFF"


def _counts(batches: Iterator[pa.RecordBatch], thinned: int, least_length: int) -> Iterator[pa.RecordBatch]:
    """(word, n): partial counts of the words of the texts."""
    total: Counter[str] = Counter()

    def counted() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

    for batch in batches:
        for row in range(batch.num_rows):
            key, text = batch.column("key")[row].as_py(), batch.column("text")[row].as_py()
            # the lower case of bytes changes A-Z only
            runs = Counter(_RUN.findall(text.encode().lower().decode()))
            start = zlib.crc32(b"%s:" % (b"" if key is None else b"%d" % key))
            for run, n in runs.items():
                h = zlib.crc32(run.encode(), start)
                if h % thinned == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                if len(run) >= least_length:
                    total[run] += n
            if len(total) >= COUNTED_WORDS:
                yield counted()
                total.clear()
    yield counted()


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", thinned: int = THINNED,
               least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of all texts that are long and frequent enough, with their counts.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased.  Where ``thinned`` divides
    h = crc32("<key>:<run>"), the run loses its code point h % length.  A null text has no words; a null
    key counts as an empty one.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    counts = rows.mapInArrow(partial(_counts, thinned=thinned, least_length=least_length), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def one_edit_apart(query: str, words: list[str], lcps: list[int], shared: int) -> list[str]:
    """The words of a sorted list that are exactly one edit from ``query``.

    ``lcps[i]`` is the length of the common prefix of words i - 1 and i; all words and the query
    share their first ``shared`` code points.  Row d of the edit matrix, of the list word's first d
    code points, holds the distances to the query's first d - 1, d and d + 1, two standing for more.
    """
    found, length = [], len(query)
    rows = [(1, 0, 1)]  # rows[k] is row shared + k
    i = 0
    while i < len(words):
        word = words[i]
        depth = min(shared + len(rows) - 1, lcps[i]) if i else shared
        del rows[depth - shared + 1:]
        a, b, c = rows[-1]
        dead = False
        while depth < len(word):
            x = word[depth]
            a2 = min(a + (depth < 1 or depth > length or x != query[depth - 1]), b + 1)
            b2 = min(b + (x != query[depth]), c + 1, a2 + 1) if depth < length else 2
            c2 = min(c + (x != query[depth + 1]), b2 + 1) if depth + 1 < length else 2
            depth += 1
            if a2 > 1 and b2 > 1 and c2 > 1:
                dead = True
                break
            a, b, c = a2, b2, c2
            rows.append((a, b, c))
        if dead:  # every word that goes on from this prefix is further away
            i += 1
            if i < len(words) and lcps[i] >= depth:
                i = bisect_left(words, word[:depth] + _PAST, i)  # its LCP is also the one with `word`
            continue
        distance = (a, b, c)[length - depth + 1] if abs(length - depth) <= 1 else 2
        if distance == 1:
            found.append(word)
        i += 1
    return found


def _scan(part: pd.DataFrame) -> pd.DataFrame:
    """Near pairs (longer, other) of the lists of one task; the longer words of a list form the sorted one."""
    rows = sorted(zip(part["key"], part["m"], part["p"], part["s"], part["word"]))
    found = []
    for (_, m, p, s), members in groupby(rows, key=lambda r: r[:4]):
        back = s > p
        members = [r[4] for r in members]
        # the sorted list runs from the end that more of the word is shared at
        oriented = sorted(w[::-1] for w in members) if back else members
        words = [w for w in oriented if len(w) == m]
        if not words or len(oriented) < 2:
            continue
        lcps = [0] + [_common(x, y) for x, y in zip(words, words[1:])]
        for query in oriented:
            for word in one_edit_apart(query, words, lcps, s if back else p):
                if len(query) < m or word < query:  # pairs of equal length once
                    found.append((word[::-1], query[::-1]) if back else (word, query))
    return pd.DataFrame(found, columns=["u", "v"], dtype="str")


def _dealt(lists: DataFrame) -> DataFrame:
    """Every list dealt by half of what its words may still differ in, at their front and at their back.

    With p and s code points shared at the ends and one edit in the m - p - s left, half of these agree at one end.
    """
    half = ((F.col("m") - F.col("p") - F.col("s")) / 2).cast("int")
    ends = F.explode(F.array(F.struct((F.col("p") + half).alias("p"), F.col("s").alias("s")),
                             F.struct(F.col("p").alias("p"), (F.col("s") + half).alias("s"))))
    more = lists.withColumn("ends", ends).select("word", "m", F.col("ends.p").alias("p"), F.col("ends.s").alias("s"))
    front, back = F.left("word", F.col("p")), F.right("word", F.col("s"))
    return more.withColumn("key", F.xxhash64("m", "p", "s", front, back))


def near_pairs(words: DataFrame, members: int = MEMBERS) -> DataFrame:
    """(u, v): all pairs of distinct words that differ by one inserted, deleted or replaced code point, each way round.

    Words need at least two code points.  A pair is found from both ends if both agree, so pairs are made distinct.
    """
    length = F.char_length("word")
    start = words.select("word", F.explode(F.array(length, length + 1)).alias("m"), F.lit(0).alias("p"), F.lit(0).alias("s"))
    lists, scanned = written(_dealt(start), "lists"), []
    while True:
        crowd = lists.groupBy("key").agg(F.count("*").alias("n"), F.first("m").alias("m"), F.first("p").alias("p"),
                                         F.first("s").alias("s")).filter("n > 1")
        crowd = written(crowd.select("key", ((F.col("n") > members) & (F.col("m") - F.col("p") - F.col("s") > 1)).alias("crowded"), "n"), "crowd")
        open_lists = lists.join(crowd.drop("n"), "key")
        scanned.append(open_lists.filter("NOT crowded").drop("crowded"))
        if crowd.filter("crowded").isEmpty():
            break
        lists = written(_dealt(open_lists.filter("crowded").drop("crowded", "key")).distinct(), "lists")
    every = scanned[0]
    for frame in scanned[1:]:
        every = every.unionByName(frame)
    every = written(every, "lists")
    tasks = max(1, every.count() // TASK_WORDS)
    # few bytes are much work here, so the number of tasks is set and not left to their size
    pairs = (every.withColumn("task", F.pmod(F.xxhash64("key"), F.lit(tasks))).repartition(tasks, "task").groupBy("task")
             .applyInPandas(_scan, "u string, v string"))
    return pairs.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*").distinct()


def _rooted(forms: DataFrame) -> DataFrame:
    """(word, root) for words that have a form, by doubling the distance that each pointer spans.

    A form is more frequent than its word, so chains end.
    """
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        beyond = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = written(now.join(beyond, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if now.filter("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def spelling_variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """One row per word of ``words`` (word, n): word, form, root, n, n_near, form_n.

    n_near counts the near words; form is the most frequent of them (ties: the smallest in code-point order)
    if it occurs at least ``factor`` times (two or more) as often as the word, else null; root is where following forms ends.
    An empty vocabulary has no rows.
    """
    words = written(words.select("word", "n"), "words")
    of_other = words.select(F.col("word").alias("v"), F.col("n").alias("m"))
    rank: Column = F.struct((-F.col("m")).alias("m"), "v")
    best = (near_pairs(words).join(of_other, "v").groupBy(F.col("u").alias("word"))
            .agg(F.count("*").alias("n_near"), F.min(rank).alias("best")))
    formed = words.join(best, "word", "left")
    frequent = -F.col("best.m") >= F.lit(factor) * F.col("n")
    formed = written(formed.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                   F.when(frequent, F.col("best.v")).alias("form"), F.when(frequent, -F.col("best.m")).alias("form_n")), "forms")
    return formed.join(_rooted(formed.filter("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def oracle_sql() -> str:
    """The query's rows by words with one place left open or out."""
    table = [*range(256)]
    for _ in range(8):
        table = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in table]
    return rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
        FROM documents) GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2),
           lambda i: 16 * (instr('0123456789ABCDEF', substr(x, 2 * i + 1, 1)) - 1) + instr('0123456789ABCDEF', substr(x, 2 * i + 2, 1)) - 1)),
         lambda c, b: xor(c >> 8, ({table}::BIGINT[])[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM (SELECT run, n, hex(coalesce(doc_id::VARCHAR, '') || ':' || run) AS x FROM runs)),
counted AS (
  SELECT CASE WHEN h % {THINNED} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word,
         sum(n)::BIGINT AS n FROM hashed GROUP BY 1),
words AS (SELECT word, n FROM counted WHERE length(word) >= {LEAST_LENGTH} AND n >= {LEAST_COUNT}),
gaps AS (SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT x.word, y.word AS other FROM gaps x JOIN gaps y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT g.word, w.word FROM gaps g JOIN words w ON w.word = g.a || g.b
  UNION SELECT w.word, g.word FROM gaps g JOIN words w ON w.word = g.a || g.b),
best AS (
  SELECT near.word, other, m.n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY m.n DESC, other) AS place
  FROM near JOIN words m ON m.word = other),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= {FACTOR} * w.n THEN other END AS form,
         CASE WHEN b.n >= {FACTOR} * w.n THEN b.n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word AND place = 1),
chain(word, reached, form) AS (
  SELECT word, word, form FROM formed
  UNION ALL SELECT chain.word, formed.word, formed.form FROM chain JOIN formed ON formed.word = chain.form)
SELECT f.word, f.form, chain.reached AS root, f.n, f.n_near, f.form_n FROM formed f JOIN chain ON chain.word = f.word AND chain.form IS NULL"""
