"""A Merkle manifest of a table: a tree per source, one tree over the subroots, and a proof per row by pointer jumping.

Every node points to its parent and holds the segment of its siblings' digests.  Joining a node with the
node it points to doubles the distance and concatenates the segments, so the leaves reach the root
after as many joins as the tree's height has binary digits.

Rows get their places by ranges of (source, key), so a source of any size is numbered and built in many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coverlens.llm.common import written

ARITY = 3
LEVELS = 4               # levels built from one block
BLOCK = ARITY**LEVELS
RANGE_ROWS = 50_000      # rows of one range, about
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_DIGEST = 64             # hex digits


def leaf_of(*values: Column) -> Column:
    """Digest of a row: `-` for each null, else the UTF-8 byte count, a colon and the value."""
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-"))
                             for v in values]), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``idx`` (place within its tree, from 0) and ``width`` (rows of the tree).

    ``tree`` is never null.  Equal rows are told apart by a number that the written table fixes.
    """
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    parts = 1 + rows.count() // RANGE_ROWS
    order = [*order, "_row"]
    ranged = written(rows.repartitionByRange(parts, "tree", *order).withColumn("_part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("tree", "_part").agg(F.count("*").alias("_n"))
    of_tree = W.partitionBy("tree").orderBy("_part")
    starts = counts.select("tree", "_part", (F.sum("_n").over(of_tree) - F.col("_n")).alias("_start"),
                           F.sum("_n").over(W.partitionBy("tree")).alias("width"))
    place = F.row_number().over(W.partitionBy("_part", "tree").orderBy(*order))
    return (ranged.withColumn("_place", place).join(starts, ["tree", "_part"])
            .withColumn("idx", F.col("_start") + F.col("_place") - 1).drop("_start", "_place", "_part", "_row"))


def _parents(level: Column) -> Column:
    """Digests of every ARITY consecutive ones."""
    starts = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / ARITY).cast("int"))
    return F.transform(starts, lambda i: F.sha2(F.array_join(F.slice(level, i * ARITY + 1, ARITY), ""), 256))


def _pointers(level: Column, number: int) -> Column:
    """Of each digest of a block's level: place in the block, siblings' digests left to right, and how many stand on each side."""
    def pointer(digest: Column, i: Column) -> Column:
        left = i % ARITY
        run = F.slice(level, i - left + 1, ARITY)
        others = F.concat(F.slice(run, F.lit(1), left), F.slice(run, left + 2, ARITY))
        return F.struct(F.lit(number).alias("level"), i.alias("i"), F.array_join(others, "").alias("segment"),
                        F.array((left * ARITY + F.size(run) - 1 - left).cast("int")).alias("shape"))
    return F.transform(level, pointer)


def _build(nodes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(leaves, inner, tops, height) of the trees over ``nodes`` (tree, idx, width, digest, payload).

    leaves: tree, idx, payload, digest, segment, shape; inner: tree, level, idx, segment, shape of all other nodes
    below a root; tops: tree, digest, height of each tree's root; height: that of the highest tree.
    Each round turns blocks of BLOCK nodes into LEVELS levels.
    """
    leaves, inner, tops, base = None, None, None, 0
    while True:
        blocks = nodes.groupBy("tree", "width", F.floor(F.col("idx") / BLOCK).alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("idx", "digest", "payload"))).alias("members"))
        # level k of a tree has width k nodes; there is none above a single one
        blocks = blocks.withColumn("width0", F.col("width")).withColumn("level0", F.col("members.digest"))
        for k in range(LEVELS):
            several = F.col(f"width{k}") > 1
            blocks = (blocks.withColumn(f"level{k + 1}", F.when(several, _parents(F.col(f"level{k}"))))
                      .withColumn(f"width{k + 1}", F.when(several, F.ceil(F.col(f"width{k}") / ARITY))))
        blocks = written(blocks, "blocks")
        found = F.concat(*[F.when(F.col(f"width{k}") > 1, _pointers(F.col(f"level{k}"), k)).otherwise(F.array()) for k in range(LEVELS)])
        sized = F.element_at(F.array(*[F.lit(ARITY**(LEVELS - k)) for k in range(LEVELS)]), F.col("p.level") + 1)
        pointers = blocks.select("tree", "block", F.explode(found).alias("p")).select(
            "tree", (F.col("p.level") + base).alias("level"), (F.col("block") * sized + F.col("p.i")).alias("idx"), "p.segment", "p.shape")
        if base == 0:
            lone = F.array(F.struct(F.lit(0).alias("level"), F.lit(0).alias("i"), F.lit("").alias("segment"),
                                    F.array().cast("array<int>").alias("shape")))
            own = F.when(F.col("width0") > 1, _pointers(F.col("level0"), 0)).otherwise(lone)
            both = F.zip_with("members", own, lambda m, p: F.struct(m.alias("m"), p.alias("p")))
            leaves = (blocks.select("tree", F.explode(both).alias("z"))
                      .select("tree", "z.m.idx", "z.m.payload", "z.m.digest", "z.p.segment", "z.p.shape"))
            pointers = pointers.filter("level > 0")
        inner = pointers if inner is None else inner.unionByName(pointers)
        done = None
        for k in range(LEVELS + 1):
            at = blocks.filter(F.col(f"width{k}") == 1).select(
                "tree", F.element_at(f"level{k}", 1).alias("digest"), F.lit(base + k).alias("height"))
            done = at if done is None else done.unionByName(at)
        tops = done if tops is None else tops.unionByName(done)
        base += LEVELS
        left = blocks.filter(F.col(f"width{LEVELS}") > 1)
        if left.isEmpty():
            tops = written(tops, "tops")
            return leaves, inner, tops, tops.agg(F.max("height")).first()[0] or 0
        nodes = left.select("tree", F.col(f"width{LEVELS}").alias("width"), F.col("block").alias("idx"),
                            F.element_at(f"level{LEVELS}", 1).alias("digest"), F.lit(None).cast("string").alias("payload"))


def _reached(leaves: DataFrame, inner: DataFrame, height: int) -> DataFrame:
    """``leaves`` with their segments up to the root of their tree: each join doubles the distance."""
    reach = 1
    inner = written(inner, "pointers")
    while reach < height:
        # `inner` spans `reach` levels from each level that `reach` divides
        step = F.lit(ARITY**reach)
        ahead = inner.filter(F.col("level") == reach).select(
            "tree", F.col("idx").alias("_up"), F.col("segment").alias("_segment"), F.col("shape").alias("_shape"))
        leaves = (leaves.withColumn("_up", F.floor(F.col("idx") / step)).join(ahead, ["tree", "_up"], "left")
                  .withColumn("segment", F.concat("segment", F.coalesce("_segment", F.lit(""))))
                  .withColumn("shape", F.concat("shape", F.coalesce("_shape", F.array().cast("array<int>"))))
                  .drop("_up", "_segment", "_shape"))
        further = inner.select("tree", (F.col("level") - reach).alias("level"), F.col("idx").alias("_up"),
                               F.col("segment").alias("_segment"), F.col("shape").alias("_shape"))
        lower = inner.filter((F.col("level") % (2 * reach) == 0) & (F.col("level") > 0)).withColumn("_up", F.floor(F.col("idx") / step))
        inner = written(lower.join(further, ["tree", "level", "_up"], "left").select(
            "tree", "level", "idx", F.concat("segment", F.coalesce("_segment", F.lit(""))).alias("segment"),
            F.concat("shape", F.coalesce("_shape", F.array().cast("array<int>"))).alias("shape")), "pointers")
        reach *= 2
    return leaves


def folded(leaf: Column, segment: Column, shape: Column) -> Column:
    """The root that a leaf's digest and its siblings' digests lead to."""
    def step(state: Column, sides: Column) -> Column:
        left, right = F.floor(sides / ARITY).cast("int") * _DIGEST, (sides % ARITY) * _DIGEST
        content = F.concat(F.substr(segment, state["at"], left), state["digest"], F.substr(segment, state["at"] + left, right))
        return F.struct(F.sha2(content, 256).alias("digest"), (state["at"] + left + right).alias("at"))
    return F.aggregate(shape, F.struct(leaf.alias("digest"), F.lit(1).alias("at")), step, lambda state: state["digest"])


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", source: str = "source",
             carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: ``key``, leaf, segment, shape, subroot, root and the ``carry`` columns.

    A leaf is the digest of ``fields``.  Leaves of a source ascend by ``key`` (nulls first; equal keys by leaf); every three
    consecutive nodes make one of the next level until one is left, the subroot.  Subroots in the order of
    their sources (null first, then by UTF-8 bytes) make the root in the same way.  A node alone in its tree is its root.
    ``segment`` holds the digests of the siblings on the way to the root, left to right and level by level, and ``shape``
    per level 3 * (siblings to the left) + (to the right).  Equal rows are leaves of their own.  An empty table has no rows.
    Columns named otherwise play no part.
    """
    carry = carry or {}
    tree = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))  # keeps the order, null first
    payload = F.struct(F.col(key).alias("key"), *[c.alias(name) for name, c in carry.items()])
    rows = docs.select(tree.alias("tree"), leaf_of(*[F.col(f) for f in fields]).alias("digest"), payload.alias("payload"))
    rows = numbered(rows.withColumn("order", F.col("payload.key")), ["order", "digest"]).drop("order")
    leaves, inner, tops, height = _build(rows)
    leaves = _reached(leaves, inner, height)

    subroots = tops.select(F.lit("").alias("tree"), F.col("tree").alias("order"), "digest")
    placed = numbered(subroots, ["order"]).withColumnRenamed("order", "payload")
    upper, upper_inner, root, upper_height = _build(placed)
    upper = written(_reached(upper, upper_inner, upper_height).select(
        F.col("payload").alias("tree"), F.col("digest").alias("subroot"), F.col("segment").alias("_segment"), F.col("shape").alias("_shape")), "subroots")
    only = root.first()  # one row, or none of an empty table
    return leaves.join(upper, "tree").select(
        F.col("payload.key").alias(key), F.col("digest").alias("leaf"), F.concat("segment", "_segment").alias("segment"),
        F.concat("shape", "_shape").alias("shape"), "subroot", F.lit(only and only["digest"]).cast("string").alias("root"),
        *[F.col(f"payload.{name}").alias(name) for name in carry])


def tampered_manifest(docs: DataFrame) -> DataFrame:
    """One row per row of documents: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Where 2 divides crc32(doc_id), the text loses its line feeds after the manifest was made; folded_root is
    recomputed from the leaf of the row as it is then and the siblings of the manifest.  Rows without an id stay as they are.
    """
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    received = leaf_of(*[F.coalesce(text, F.col("text")) if f == "text" else F.col(f) for f in FIELDS])
    proofs = manifest(docs, carry={"received": received})
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.col("segment"), 256).alias("proof_sha256"),
        folded(F.col("received"), F.col("segment"), F.col("shape")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle_sql() -> str:
    """The query's rows by trees built level by level and paths read off them."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: f"sha256({' || '.join(field(text if f == 'text' else f) for f in FIELDS)})"
    climb = """SELECT tree, lvl + 1, idx // 3, any_value((width + 2) // 3), sha256(string_agg(h, '' ORDER BY idx))
    FROM {0} WHERE width > 1 GROUP BY tree, lvl, idx // 3"""
    crc = [*range(256)]
    for _ in range(8):
        crc = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in crc]
    return f"""
WITH RECURSIVE crc AS (
  SELECT doc_id, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(doc_id::VARCHAR)),
           lambda i: ascii(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT)),
         lambda c, b: xor(c >> 8, ({crc}::BIGINT[])[(xor(c, b) & 255) + 1])) AS c
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {leaf('text')} AS leaf,
         CASE WHEN xor(c, 4294967295) % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS received
  FROM documents LEFT JOIN crc USING (doc_id)),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
                  count(*) OVER (PARTITION BY tree) AS width FROM leaves),
node(tree, lvl, idx, width, h) AS (SELECT tree, 0, idx, width, leaf FROM placed UNION ALL {climb.format('node')}),
subroots AS (SELECT tree AS sub, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS width FROM node WHERE width = 1),
upper(tree, lvl, idx, width, h) AS (SELECT 'top', 0, idx, width, subroot FROM subroots UNION ALL {climb.format('upper')}),
steps AS (
  SELECT tree, p.idx AS leaf_idx, 0 AS part, n.lvl, n.idx, n.h, p.idx // pow(3, n.lvl)::BIGINT AS own
  FROM placed p JOIN node n USING (tree) WHERE n.width > 1 AND n.idx // 3 = p.idx // pow(3, n.lvl + 1)::BIGINT
  UNION ALL
  SELECT p.tree, p.idx, 1, n.lvl, n.idx, n.h, s.idx // pow(3, n.lvl)::BIGINT
  FROM placed p JOIN subroots s ON s.sub = p.tree JOIN upper n ON n.width > 1 AND n.idx // 3 = s.idx // pow(3, n.lvl + 1)::BIGINT),
sides AS (
  SELECT tree, leaf_idx, part, lvl, coalesce(string_agg(h, '' ORDER BY idx) FILTER (idx < own), '') AS l,
         coalesce(string_agg(h, '' ORDER BY idx) FILTER (idx > own), '') AS r
  FROM steps GROUP BY tree, leaf_idx, part, lvl),
paths AS (
  SELECT tree, leaf_idx AS idx, string_agg(l || r, '' ORDER BY part, lvl) AS siblings, list(l || '|' || r ORDER BY part, lvl) AS path
  FROM sides GROUP BY tree, leaf_idx),
folded AS (
  SELECT p.doc_id, p.leaf, s.subroot, (SELECT h FROM upper WHERE width = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
         list_reduce(list_prepend(p.received, coalesce(path, [])), lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) AS folded_root
  FROM placed p JOIN subroots s ON s.sub = p.tree LEFT JOIN paths q ON q.tree = p.tree AND q.idx = p.idx)
SELECT *, folded_root = root AS verified FROM folded"""
