"""Near-duplicate documents: SuperMinHash signatures, banding, links confirmed on full sets, union-find grouping.

Documents of equal shingle sets form one class.  Class representatives whose signatures
agree in a whole band share a bucket.  A bucket first links its members to one leader;
only members that are then still in different groups are compared with each other, so
a large group of near copies costs one comparison a member, not one a pair.  These
comparisons take place where the members' sets are; only links leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens.llm.common import SHINGLE_WORDS, mix64, prefix_hashes, substring_hashes, written
from coverlens.llm.components import components

SIMILAR = 85            # per cent of the union that two documents share at least
BANDS, ROWS = 32, 8     # misses a pair at exactly that similarity with probability 0.00004
SIGNATURE = BANDS * ROWS
MARGIN = 4.0            # standard errors by which a signature may fall short of the similarity
BLOCK_ROWS = 1_000      # members of one bucket compared with each other at a time
BLOCK_SHINGLES = 2_000_000  # shingles that such a block holds, a longer set alone
PAIRS_PER_SET = 1_000   # pairs that one copy of a document's full set is compared in
KEYLESS = 1 << 62
SURROGATE = KEYLESS + (1 << 61)  # nodes of classes whose smallest key has further texts
CHUNK_BYTES = 1_000_000  # texts hashed together; a longer text is hashed alone

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLACE = np.random.default_rng(7).integers(1, 2**63, max(SHINGLE_WORDS, SIGNATURE), dtype=np.uint64) | np.uint64(1)


def _salt(j: int) -> np.uint64:
    return np.uint64(j * 0xD1B54A32D192ED03 % 2**64)


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle hash), sorted and distinct: hashes of five-word runs of A-Z lower-cased texts.

    A text of fewer words has one shingle, its whole sequence; one without words has none.
    """
    joined = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    data = _LOWER[joined]
    ends_of = np.cumsum([len(t) + 1 for t in texts])
    edge = np.diff(np.concatenate([[True], _SPACE[data]]).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(starts) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    words = substring_hashes(prefix_hashes(data), starts, ends)
    text_of = np.searchsorted(ends_of, starts, side="right")
    first = np.flatnonzero(np.concatenate([[True], text_of[1:] != text_of[:-1]]))  # each text's first word
    count = np.diff(np.concatenate([first, [len(words)]]))
    short = count < SHINGLE_WORDS
    padded = np.concatenate([words, np.zeros(SHINGLE_WORDS, np.uint64)])
    runs = np.zeros(len(words), dtype=np.uint64)
    for k in range(SHINGLE_WORDS):
        runs += padded[k:k + len(words)] * _PLACE[k]
    left = np.repeat(first + count, count) - np.arange(len(words))  # words from here to the text's end
    keep = left >= SHINGLE_WORDS
    for i in np.flatnonzero(short):  # at most four words each
        at = first[i]
        runs[at] = np.sum(words[at:at + count[i]] * _PLACE[:count[i]], dtype=np.uint64) + np.uint64(count[i])
        keep[at] = True
    owner, hashes = text_of[keep], mix64(runs[keep])
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])])
    return owner[new], hashes[new]


def super_minhash(owner: np.ndarray, hashes: np.ndarray, n: int, size: int = SIGNATURE) -> np.ndarray:
    """SuperMinHash signatures (n x size) of n sets given as (set number, element hash).

    Every element draws one random permutation of the slots and offers slot p[j] the value
    j + r_j with r_j in [0, 1).  Step j is done for all elements at once; a set whose slots
    all hold less than j + 1 takes no part in later steps.  Empty sets keep infinite values.
    """
    signature = np.full(n * size, np.inf)
    alive_owner, alive, swaps = owner, hashes, []
    for j in range(size):
        if len(alive) == 0:
            break
        random = mix64(alive + _salt(j))
        fraction = (random >> np.uint64(24)).astype(np.float64) * 2.0**-40
        swap = (j + (((random & np.uint64(0xFFFFFF)) * np.uint64(size - j)) >> np.uint64(24)).astype(np.int64)).astype(np.int16)
        slot = swap.copy()
        for i in range(j - 1, -1, -1):  # undo the earlier swaps of this element's permutation
            slot[slot == swaps[i]] = i
        np.minimum.at(signature, alive_owner * size + slot, j + fraction)
        swaps.append(swap)
        open_sets = signature.reshape(n, size).max(axis=1) > j + 1
        stay = open_sets[alive_owner]
        if not stay.all():
            alive_owner, alive = alive_owner[stay], alive[stay]
            swaps = [s[stay] for s in swaps]
    return signature.reshape(n, size)


def band_hashes(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One hash per band of ``rows`` slots, as many bands as fit; the band's number is part of it."""
    bands = SIGNATURE // rows
    bits = (signature.view(np.uint64) * _PLACE[:SIGNATURE])[:, :bands * rows]
    return mix64(bits.reshape(len(signature), bands, rows).sum(axis=2, dtype=np.uint64)).view(np.int64)


def _chunks(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    at = 0
    while at < len(column):
        texts, size = [], 0
        while at + len(texts) < len(column) and (not texts or size < CHUNK_BYTES):
            texts.append((column[at + len(texts)].as_py() or "").encode())
            size += len(texts[-1])
        yield at, texts
        at += len(texts)


def _sums(owner: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two order-free 64-bit sums of each set: its identity."""
    counts = np.bincount(owner, minlength=n)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    out = []
    for salt in (_salt(1001), _salt(1002)):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(hashes ^ salt), dtype=np.uint64)])
        out.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return counts, *out


def _signatures(batches: Iterator[pa.RecordBatch], band_rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, texts in _chunks(batch.column("text")):
            owner, hashes = shingle_sets(texts)
            counts, a, b = _sums(owner, hashes, len(texts))
            signature = super_minhash(owner, hashes, len(texts))
            bands = band_hashes(signature, band_rows)
            lists = pa.ListArray.from_arrays(np.arange(0, bands.size + 1, bands.shape[1], dtype=np.int32), bands.ravel())
            marks = ((signature.view(np.uint64) * _PLACE[:SIGNATURE]) >> np.uint64(56)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").slice(at, len(texts)), pa.array(counts, pa.int64()), pa.array(a), pa.array(b), lists,
                 pa.array([m.tobytes() for m in marks], pa.binary())], ["key", "n", "a", "b", "bands", "marks"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set of each node: that of its key's text whose identity is the class's."""
    for batch in batches:
        a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
        for at, texts in _chunks(batch.column("text")):
            owner, hashes = shingle_sets(texts)
            _, *sums = _sums(owner, hashes, len(texts))
            same = pa.array((sums[0] == a[at:at + len(texts)]) & (sums[1] == b[at:at + len(texts)]))
            bounds = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").slice(at, len(texts)), pa.ListArray.from_arrays(bounds, hashes.view(np.int64))],
                ["node", "shingles"]).filter(same)


def _with_sets(pairs: DataFrame, sets: DataFrame, node: str, name: str, most: int) -> DataFrame:
    """The pairs with the full set of their column ``node``, which stands in at most ``most`` of them.

    Where some node has many pairs, pairs are dealt into parts by their other node, and sets are copied
    to the parts that their pairs are in: no node's pairs all meet in one task.
    """
    named = sets.select(F.col("node").alias(node), F.col("shingles").alias(name))
    if most <= PAIRS_PER_SET:
        return pairs.join(named, node)
    part = F.pmod(F.xxhash64("v" if node == "u" else "u"), F.lit(1 + most // PAIRS_PER_SET)).cast("int")
    dealt = pairs.withColumn("part", part)
    copies = named.join(dealt.select(node, "part").distinct(), node)
    return dealt.join(copies, [node, "part"]).drop("part")


def _full_sets(nodes: DataFrame, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, shingles) of these distinct nodes; texts move once, and only here."""
    needed = classes.select("node", "rep", "a", "b").join(nodes, "node", "left_semi")
    # a merge join: the number of documents in question grows with the table
    return written(rows.join(needed.hint("merge"), F.col("key") == F.col("rep")).select("node", "a", "b", "text")
                   .mapInArrow(_sets, "node long, shingles array<bigint>").dropDuplicates(["node"]), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs (u, v) whose full shingle sets share enough."""
    most_u, most_v = (pairs.groupBy(c).count().agg(F.max("count")).first()[0] or 0 for c in ("u", "v"))
    both = _with_sets(_with_sets(pairs, sets, "u", "x", most_u), sets, "v", "y", most_v)
    both = both.withColumn("common", F.size(F.array_intersect("x", "y")))
    return (both.filter(F.lit(100) * F.col("common") >= F.lit(similar) * (F.size("x") + F.size("y") - F.col("common")))
            .select("u", "v").distinct())


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similar: int = SIMILAR,
                    band_rows: int = ROWS) -> DataFrame:
    """One row per input row: ``key`` (an integer), n_shingles, component_id, kept.

    Two documents are linked if 100 * |intersection| >= similar * |union| of their shingle sets;
    component_id is the smallest key reachable over links.  A null text, an empty one and one
    without words have no shingles, stand alone and are kept.  Rows of equal key are one
    document: all its texts' links are its links, and all its rows carry the same component.  Rows without a key are linked too: their
    component_id is the smallest key there is, null if there is none, and they are kept only then.
    An empty table has no rows.  Other columns play no part.
    A lower ``similar`` needs bands of fewer rows.
    """
    # a row without a key gets one of its own above all usual keys
    keyless = F.lit(KEYLESS) + F.abs(F.xxhash64(F.coalesce(F.col(text), F.lit(""))) % (1 << 61))
    rows = docs.select(F.coalesce(F.col(key).cast("long"), keyless).alias("key"), F.col(text).alias("text"))
    signed = written(rows.mapInArrow(lambda batches: _signatures(batches, band_rows), "key long, n long, a long, b long, bands array<bigint>, marks binary"), "signatures")
    # keys with several texts, mostly none: their classes get nodes of their own, linked to the key
    identity = F.struct("n", "a", "b")
    several = written(signed.groupBy("key").agg(F.min(identity).alias("low"), F.max(identity).alias("high"))
                      .filter("low <> high").select("key"), "several")
    own = F.lit(SURROGATE) + F.pmod(F.xxhash64("n", "a", "b"), F.lit(1 << 61))
    classes = written(signed.filter("n > 0").groupBy("n", "a", "b").agg(
        F.min("key").alias("rep"), F.min_by(F.struct("bands", "marks"), "key").alias("of"))
        .join(several.select(F.col("key").alias("rep"), F.lit(True).alias("several")), "rep", "left").select(
        "n", "a", "b", "rep", F.when(F.col("several"), own).otherwise(F.col("rep")).alias("node"), "of.*"), "classes")
    of_key = (signed.filter("n > 0").join(several, "key", "left_semi").select("key", "n", "a", "b").distinct()
              .join(classes.select("n", "a", "b", "node"), ["n", "a", "b"]).select(F.col("key").alias("u"), F.col("node").alias("v")))

    members = classes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(
        F.count("*").alias("members"), F.min(F.struct("node", "n")).alias("leader")).filter("members > 1")
    buckets = written(members.join(shared.drop("members"), "bucket"), "buckets")
    found = components(_links(buckets, classes, rows, similar).unionByName(of_key))

    of_class = (classes.join(found, "node", "left")
                .select("n", "a", "b", F.coalesce("component", "node").alias("component")))
    of_several = several.join(found.select(F.col("node").alias("key"), F.col("component").alias("key_component")), "key")
    known = signed.select("key", "n", "a", "b").join(of_class, ["n", "a", "b"], "left").join(of_several, "key", "left")
    component = F.coalesce("key_component", "component", "key")
    named = lambda c: F.when(c < KEYLESS, c)
    return known.select(
        named(F.col("key")).alias(key), F.col("n").alias("n_shingles"), named(component).alias("component_id"),
        (F.col("key") == component).alias("kept"))


def _alike_sizes(a, b, similar: int):
    """Sets of such sizes can be similar enough at all."""
    return F.lit(100) * F.least(a, b) >= F.lit(similar) * F.greatest(a, b)


def _links(buckets: DataFrame, classes: DataFrame, rows: DataFrame, similar: int) -> DataFrame:
    """Confirmed links that connect all bucket members which any chain of links within buckets connects."""
    first = (buckets.filter(_alike_sizes(F.col("n"), F.col("leader.n"), similar) & (F.col("node") != F.col("leader.node")))
             .select(F.col("leader.node").alias("u"), F.col("node").alias("v")).distinct())
    first = written(first, "pairs")
    sets = _full_sets(buckets.select("node").distinct(), classes, rows)
    links = written(_confirmed(first, sets, similar), "links")
    # what the leaders left apart is compared directly: members of one bucket in different groups
    grouped = written(buckets.join(components(links), "node", "left")
                      .select("bucket", "node", "n", F.coalesce("component", "node").alias("component")), "grouped")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    split = grouped.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), blocks.alias("blocks")).filter(
        "low < high").select("bucket", "blocks")
    apart = grouped.join(split, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    n, shingles = apart.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # every two blocks of a large bucket meet in one task, small buckets share tasks
    small = 1 + max(n // (4 * BLOCK_ROWS), shingles // (2 * BLOCK_SHINGLES))
    task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("bucket"), F.lit(small))).otherwise(F.xxhash64("bucket", "low", "high"))
    parts = (apart.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("bucket", "node", "n", "component", "block", F.least("block", "other").alias("low"),
                     F.greatest("block", "other").alias("high"), "blocks").withColumn("task", task)
             .join(classes.select("node", "bands", "marks"), "node").join(sets, "node"))
    # written first: a task that also joined components would hold two Python workers
    rest = written(parts.groupBy("task").applyInPandas(lambda part: _links_within(part, similar), "u long, v long"), "links")
    return links.unionByName(rest)


def _links_within(part: pd.DataFrame, similar: int) -> pd.DataFrame:
    """Links that connect the members of each bucket which true links connect and that are in different groups.

    Signatures rule out most pairs, full sets decide on the others.  A link joins its groups, whose
    members are not compared with each other again.  A pair that shares several buckets is looked at
    in the first of its common bands only.
    """
    share = similar / 100
    least = SIGNATURE * (share - MARGIN * np.sqrt(share * (1 - share) / SIGNATURE))
    joined: dict[int, int] = {}  # group to the group it has become part of
    out = []

    def group_of(component: int) -> int:
        while component in joined:
            component = joined[component]
        return component

    for (bucket, low, high), rows in part.groupby(["bucket", "low", "high"], sort=False):
        marks = np.frombuffer(b"".join(rows["marks"]), np.uint8).reshape(len(rows), SIGNATURE)
        bands = np.stack(rows["bands"].to_numpy())
        sets = [np.asarray(s, dtype=np.int64).view(np.uint64) for s in rows["shingles"]]  # sorted as such
        node, n, block = (rows[c].to_numpy() for c in ("node", "n", "block"))
        group = np.array([group_of(c) for c in rows["component"].tolist()])
        place = np.arange(len(rows))
        for i in np.flatnonzero(block == low):
            partner = (block == high) & (group != group[i])
            if low == high:
                partner &= place > i
            partner &= 100 * np.minimum(n, n[i]) >= similar * np.maximum(n, n[i])
            at = np.flatnonzero(partner)
            if len(at):
                at = at[(marks[at] == marks[i]).sum(axis=1) >= least]
            if len(at):
                at = at[bands[i][np.argmax(bands[at] == bands[i], axis=1)] == bucket]
            if len(at) == 0:
                continue
            others = np.concatenate([sets[j] for j in at])
            found = sets[i][np.minimum(np.searchsorted(sets[i], others), n[i] - 1)] == others
            common = np.add.reduceat(found, np.cumsum(n[at]) - n[at], dtype=np.int64)
            for j in at[100 * common >= similar * (n[at] + n[i] - common)]:
                mine, its = int(group[i]), int(group[j])
                if mine != its:
                    out.append((node[i], node[j]))
                    joined[max(mine, its)] = min(mine, its)
                    group[group == max(mine, its)] = min(mine, its)
    return pd.DataFrame(out, columns=["u", "v"], dtype="int64")
