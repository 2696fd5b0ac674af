"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents are aggregated by the set of sources they belong to.  Word capacity flows
from each pattern, through repetition levels of rising cost, to the quotas of its
sources; so words are repeated only where nothing fresh is left.  Each pattern's flow is
then served by whole repetitions and a seeded choice of documents for the rest.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverlens.llm.common import hash_order, words_of, written
from coverlens.llm.merkle import numbered

REPEATS = 3        # a document is taken at most so many times, a source so many times its size
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
FILL_ROUNDS = 4    # passes that fill a pattern's remainder with documents that still fit
MAX_PATTERNS = 20_000  # memberships sharing sources that the flow is solved for; more are refused, not cut


def water_fill(total: int, sizes: list[int], weights: list[int], repeats: int = REPEATS) -> list[float]:
    """Shares of ``total`` by weight; a share stops at ``repeats`` sizes and its excess goes to the others by weight."""
    rest, weight, targets = total, sum(weights), [0.0] * len(sizes)
    by_ratio = sorted(range(len(sizes)), key=lambda i: (sizes[i] / weights[i], i))
    for place, i in enumerate(by_ratio):
        if repeats * sizes[i] * weight > rest * weights[i]:
            for j in by_ratio[place:]:
                targets[j] = rest * weights[j] / weight
            break
        targets[i] = float(repeats * sizes[i])
        rest, weight = rest - repeats * sizes[i], weight - weights[i]
    return targets


def min_cost_flow(capacity: list[int], members: list[list[int]], quota: list[int],
                  repeats: int = REPEATS) -> list[dict[int, int]]:
    """Words that each pattern sends to each of its sources.

    Pattern p may send ``capacity[p]`` words at each repetition level; level k costs k a word.
    As much of the quotas as possible is met, at the least total cost: successive shortest
    paths with potentials, one connected part of the graph at a time.
    """
    sent: list[dict[int, int]] = [defaultdict(int) for _ in capacity]
    for part in _parts(members, len(quota)):
        _flow_of_part(part, capacity, members, quota, repeats, sent)
    return sent


def _parts(members: list[list[int]], n_sources: int) -> list[list[int]]:
    """Patterns grouped by connected part (patterns that share sources)."""
    root = list(range(n_sources))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for sources in members:
        for s in sources[1:]:
            root[find(s)] = find(sources[0])
    parts = defaultdict(list)
    for p, sources in enumerate(members):
        if sources:
            parts[find(sources[0])].append(p)
    return list(parts.values())


def _flow_of_part(part, capacity, members, quota, repeats, sent) -> None:
    used = {p: 0 for p in part}
    left = {s: quota[s] for p in part for s in members[p]}
    patterns_of = defaultdict(list)
    for p in part:
        for s in members[p]:
            patterns_of[s].append(p)
    while True:
        # cheapest fresh word of each pattern, then shortest way over shifts between sources
        cost, before = {}, {}
        queue = [(used[p] // capacity[p], p) for p in part if capacity[p] and used[p] < repeats * capacity[p]]
        heapq.heapify(queue)
        for c, p in queue:
            cost[p] = c
        goal, seen_sources = None, {}
        done = set()
        while queue:
            c, p = heapq.heappop(queue)
            if p in done or c > cost[p]:
                continue
            done.add(p)
            for s in members[p]:
                if s in seen_sources:
                    continue
                seen_sources[s] = p
                if left[s] > 0:
                    goal = s
                    break
                for other in patterns_of[s]:  # a word that ``other`` sends to s may go elsewhere instead
                    if sent[other][s] > 0 and c < cost.get(other, 1 << 60):
                        cost[other], before[other] = c, s
                        heapq.heappush(queue, (c, other))
            if goal is not None:
                break
        if goal is None:
            return
        path, s, amount = [], goal, left[goal]
        while True:
            p = seen_sources[s]
            path.append((p, s))
            if p not in before:
                break
            s = before[p]
            amount = min(amount, sent[p][s])
        first = path[-1][0]
        amount = min(amount, capacity[first] - used[first] % capacity[first])
        for p, s in path:
            sent[p][s] += amount
            if p in before:
                sent[p][before[p]] -= amount
        used[first] += amount
        left[goal] -= amount


def _shares(sizes: DataFrame, total: int, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """``water_fill`` over a table of sources (source, size): adds ``target``.

    Shares that stop leave more to the others, so the sources that stop only become more; two sums a pass go to the driver.
    """
    in_order = sizes.select(F.lit("").alias("tree"), F.isnull("source").alias("last"), "source", "size")
    cycle = F.array(*[F.lit(w) for w in weights])
    weighted = written(numbered(in_order, ["last", "source"]).select(
        "source", "size", F.get(cycle, (F.col("idx") % len(weights)).cast("int")).alias("w")), "weights")
    whole = lambda c: c.cast("decimal(38,0)")
    full, rest, weight = F.lit(False), total, None
    while True:
        sums = weighted.filter(~full).agg(F.sum(whole(F.col("w"))).alias("w")).first()
        given = weighted.filter(full).agg(F.sum(whole(F.col("size"))).alias("n")).first()["n"] or 0
        rest = total - repeats * int(given)
        if int(sums["w"] or 0) == (weight or 0):
            break
        weight = int(sums["w"])
        stops = whole(F.col("size")) * F.lit(repeats * weight).cast("decimal(38,0)") <= whole(F.col("w")) * F.lit(rest).cast("decimal(38,0)")
        full = full | stops
    share = F.lit(float(rest)) * F.col("w") / F.lit(float(weight or 1))
    return weighted.select("source", "size", F.when(full, (F.col("size") * repeats).cast("double")).otherwise(share).alias("target"))


def _flow(patterns: DataFrame, shares: DataFrame, repeats: int) -> DataFrame:
    """(of, words): what each of the patterns that share sources sends, by min-cost flow on the driver.

    Patterns of one source that no other pattern names need no flow and are left out."""
    named = patterns.select("of", F.explode("pattern").alias("source"))
    joint = patterns.filter(F.size("pattern") > 1).select(F.explode("pattern").alias("source")).distinct()
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    mine = named.join(joint, same(named, joint), "left_semi").select("of").distinct()
    found = patterns.join(mine, "of").limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} memberships that share sources")
    # sources of these patterns, at most as many as they name
    quotas = [(r["source"], int(r["target"])) for r in shares.join(joint, same(shares, joint), "left_semi").collect()]
    in_order = lambda s: (s is None, s or "")
    place = {s: i for i, (s, _) in enumerate(sorted(quotas, key=lambda q: in_order(q[0])))}
    found = sorted(found, key=lambda p: [in_order(s) for s in sorted(p["pattern"], key=in_order)])
    members = [[place[s] for s in sorted(p["pattern"], key=in_order)] for p in found]
    quota = [t for _, t in sorted(quotas, key=lambda q: in_order(q[0]))]
    sent = min_cost_flow([int(p["size"]) for p in found], members, quota, repeats)
    return patterns.sparkSession.createDataFrame([(p["of"], sum(s.values())) for p, s in zip(found, sent)], "of string, words long")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        seed: str = SEED, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """One row per input row: ``key``, size, source_size, target, taken (words the mix takes).

    ``source`` is a string or an array of strings (a document of several sources).  Sources in
    code point order, null last, weigh ``weights`` in turn.  A document is taken a whole number of
    times.  A null or empty text has size 0 and nothing to take; an empty array of sources takes no
    part.  For an array, source_size and target are those of its first source.  Rows of equal key
    are ordered by size; equal rows are interchangeable.  An empty table has no rows.

    There may be any number of sources.  Only memberships that share sources with others, at most
    MAX_PATTERNS, go through the flow; a source of its own sends its target.
    """
    many = dict(docs.dtypes)[source].startswith("array")
    pattern = F.array_sort(F.array_distinct(F.col(source))) if many else F.array(F.col(source))
    pattern = F.coalesce(pattern, F.array(F.lit(None).cast("string")))
    rows = written(docs.select(
        F.col(key).alias("key"), F.size(words_of(F.col(text))).cast("long").alias("size"),
        pattern.alias("pattern"), F.to_json(F.struct(pattern.alias("p"))).alias("of")).withColumn(
        "ord", hash_order(F.lit(seed), F.coalesce(F.col("key").cast("string"), F.lit("")))), "mix-rows")

    patterns = written(rows.groupBy("of").agg(F.first("pattern").alias("pattern"), F.sum("size").alias("size"),
                                              F.count("*").alias("rows")), "patterns")
    sizes = patterns.select(F.explode("pattern").alias("source"), "size").groupBy("source").agg(F.sum("size").alias("size"))
    total = patterns.filter(F.size("pattern") > 0).agg(F.sum("size")).first()[0] or 0
    shares = written(_shares(sizes, int(total), weights, repeats), "shares")
    # nulls stand at the end of a sorted array, as their source does
    first = F.get("pattern", F.lit(0))
    named = patterns.withColumn("first", first).join(
        shares.select(F.col("source").alias("_source"), F.col("size").alias("source_size"), "target"),
        first.eqNullSafe(F.col("_source")) & (F.size("pattern") > 0), "left")
    words = F.when(F.size("pattern") == 1, F.floor("target")).otherwise(0)
    if many:
        named = named.join(_flow(patterns, shares, repeats), "of", "left")
        words = F.coalesce(F.col("words"), words)
    some = F.col("size") > 0
    plan = written(named.select(
        "of", F.coalesce("source_size", F.lit(0)).alias("source_size"), F.coalesce("target", F.lit(0.0)).alias("target"),
        F.when(some, F.floor(words / F.col("size"))).otherwise(0).cast("long").alias("whole"),
        F.when(some, F.pmod(words, F.col("size"))).otherwise(0).cast("long").alias("rest"), "rows",
        F.array().cast(ROUND).alias("rounds")).withColumn("open", F.col("rest")), "plan")
    chosen = _seeded_choice(rows.drop("pattern"), plan)
    return chosen.select(F.col("key").alias(key), "size", "source_size", "target",
                         (F.col("size") * (F.col("whole") + F.col("chosen").cast("long"))).alias("taken"))


ROUND = "array<struct<rest:long,bucket:string,ord:string,size:long>>"


def _seeded_choice(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds the plan's columns and ``chosen``: documents, in seeded order, that fill their pattern's rest.

    A round takes, of the documents not above what is left (``open``), the first ones that fit together;
    what it leaves is for the next round's smaller documents.  A round is described by one
    place in the order per pattern, found from sums per hash bucket and within one bucket.  There are about as many
    buckets as rows in a bucket of the largest pattern, so neither window grows as the pattern does.
    """
    largest = plan.agg(F.max("rows")).first()[0] or 1
    digits = max(1, math.ceil(math.log(largest, 16) / 2))
    bucket = F.substring("ord", 1, digits)
    for _ in range(FILL_ROUNDS):
        if plan.filter("open > 0").isEmpty():
            break
        state = _with_plan(rows, plan, bucket)
        open_rows = (state.filter(~F.col("chosen") & (F.col("size") > 0) & (F.col("size") <= F.col("open")))
                     .select("of", "open", "ord", "size", bucket.alias("bucket")))
        buckets = open_rows.groupBy("of", "open", "bucket").agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("of").orderBy("bucket"))
        edges = (buckets.withColumn("upto", upto).filter("upto > open")
                 .groupBy("of").agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before")), "bucket").alias("edge"))
                 .select("of", F.col("edge.bucket").alias("bucket"), "edge.before"))
        edge_rows = open_rows.join(edges, ["of", "bucket"])
        # rows of equal key and size stand or fall together
        inside = F.sum("size").over(Window.partitionBy("of").orderBy("ord", "size")
                                    .rangeBetween(Window.unboundedPreceding, Window.currentRow))
        marks = (edge_rows.withColumn("upto", F.col("before") + inside).groupBy("of", "bucket").agg(
            F.max(F.when(F.col("upto") <= F.col("open"), F.struct("ord", "size"))).alias("last")))
        # without an edge all that is open fits
        mark = F.struct(F.col("open").alias("rest"), F.coalesce("bucket", F.lit("~")).alias("bucket"),
                        F.coalesce("last.ord", F.lit("")).alias("ord"), F.coalesce("last.size", F.lit(0)).cast("long").alias("size"))
        marked = written(plan.join(marks, "of", "left").withColumn("rounds", F.concat("rounds", F.array(mark))).select(*plan.columns), "plan")
        taken = _with_plan(rows, marked, bucket).filter("chosen").groupBy("of").agg(F.sum("size").alias("_words"))
        plan = written(marked.join(taken, "of", "left").withColumn("open", F.col("rest") - F.coalesce("_words", F.lit(0))).select(*plan.columns), "plan")
    return _with_plan(rows, plan, bucket)


def _with_plan(rows: DataFrame, plan: DataFrame, bucket: Column) -> DataFrame:
    """The rows with their pattern's plan and whether a round so far took them."""
    took = lambda r: (F.col("size") > 0) & (F.col("size") <= r["rest"]) & (
        (bucket < r["bucket"]) | ((bucket == r["bucket"]) & (F.struct("ord", "size") <= F.struct(r["ord"], r["size"]))))
    return rows.join(plan, "of").withColumn("chosen", F.exists("rounds", took))


def oracle_sql(seed: str = SEED, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> str:
    """For documents of one source each: the flow is then each source's own, level by level."""
    weight = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    rounds, done, prior = [], "SELECT *, false AS chosen, rest AS left0 FROM p", "left0"
    for i in range(1, FILL_ROUNDS + 1):
        rounds.append(f"""
c{i} AS ({done}),
t{i} AS (
  SELECT *, chosen OR (NOT chosen AND size > 0 AND size <= {prior} AND coalesce(sum(size) FILTER (NOT chosen AND size > 0 AND size <= {prior})
         OVER (PARTITION BY source ORDER BY ord, size), 0) <= {prior}) AS now
  FROM c{i})""")
        done = (f"SELECT * EXCLUDE (now, chosen), now AS chosen, rest - coalesce(sum(size) FILTER (now) "
                f"OVER (PARTITION BY source), 0) AS left{i} FROM t{i}")
        prior = f"left{i}"
    return f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         substr(md5('{seed}|' || coalesce(doc_id::VARCHAR, '')), 1, 16) AS ord
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} {weight} END AS w
  FROM d GROUP BY source),
f AS (
  SELECT *, sum(source_size) OVER () - {repeats} * coalesce(sum(source_size) OVER before, 0) AS rest_words,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS rest_weight
  FROM s WINDOW before AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT min_by(rest_words, rest_weight * -1) AS words, max(rest_weight) AS weight FROM f
          WHERE {repeats} * source_size * rest_weight > rest_words * w),
g AS (
  SELECT source, source_size, CASE WHEN {repeats} * source_size * weight > words * w
         THEN words::DOUBLE * w / weight ELSE ({repeats} * source_size)::DOUBLE END AS target
  FROM s LEFT JOIN level ON true),
p AS (
  SELECT doc_id, size, d.source, ord, source_size, target,
         CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS whole,
         CASE WHEN source_size > 0 THEN floor(target)::BIGINT % source_size ELSE 0 END AS rest
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),{",".join(rounds)}
SELECT doc_id, size, source_size, target, (size * (whole + now::INT))::BIGINT AS taken FROM t{FILL_ROUNDS}"""
