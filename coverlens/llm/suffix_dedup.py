"""Removal of long byte strings that also stand elsewhere, found by suffix arrays over blocks.

Every window of WINDOW bytes has an anchor: the leftmost of its GRAM-byte strings with the
smallest hash.  Equal windows have equal anchors at the same offset, so only windows of
anchors that occur more than once are looked at.  The windows of one anchor occurrence
form a context (they overlap); contexts of equal anchors go to the same block, and the
block's suffix array shows which windows repeat.  Anchors with very many occurrences are split by
finer keys, down to single windows, so no block is larger than a bound.

Windows of words are found the same way in the texts' word codes, CODE bytes a word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens.llm.common import prefix_hashes, substring_hashes, written
from coverlens.llm.suffix_array import repeated_windows

WINDOW = 400
GRAM = 64
SEGMENT = 1 << 22        # window starts of a text handled together
CELL = 21                # offsets per finer key
BLOCK_MEMBERS = 200      # an anchor, or a finer key, with more occurrences is split
BLOCK_BYTES = 2_000_000  # contexts of one block, about
ARRAY_BYTES = 100_000    # of them per suffix array, about

CODE = 8                 # bytes per word where windows are counted in words

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POSITION = np.uint64((1 << 24) - 1)


def _word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text."""
    space = np.concatenate([[True], _SPACE[np.frombuffer(text, np.uint8)], [True]])
    edge = np.diff(space.view(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def _word_codes(text: bytes) -> bytes:
    """A hash of CODE bytes per word, in the order of the text."""
    data, (starts, ends) = np.frombuffer(text, np.uint8), _word_bounds(text)
    out, i = [], 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, side="right")))
        prefix = prefix_hashes(data[starts[i]:ends[j - 1]])
        out.append(substring_hashes(prefix, starts[i:j] - starts[i], ends[i:j] - starts[i]).tobytes())
        i = j
    return b"".join(out)


@dataclass(frozen=True)
class Unit:
    """What windows consist of: bytes of the text, or words."""

    size: int = WINDOW
    words: bool = False

    @property
    def window(self) -> int:
        """Bytes of a window in what ``seen`` makes of a text."""
        return self.size * CODE if self.words else self.size

    @property
    def shortest(self) -> int:
        """Bytes that a text with a window has at least."""
        return 2 * self.size - 1 if self.words else self.size

    def seen(self, text: str) -> bytes:
        return _word_codes(text.encode()) if self.words else text.encode()

    def spans(self, text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of what ``seen`` made of a text as intervals of its bytes."""
        if not self.words or len(starts) == 0:
            return starts, ends
        first, last = _word_bounds(text)
        return first[-(-starts // CODE)], last[ends // CODE - 1]  # whole words only


BYTES = Unit()


def anchors(data: np.ndarray, prefix: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor place, first window start, last window start, anchor hash) for runs of windows of one anchor."""
    n_windows = len(data) - window + 1
    if n_windows < 1:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.astype(np.uint64)
    grams = np.arange(len(data) - GRAM + 1)
    hashes = substring_hashes(prefix, grams, grams + GRAM)
    ranked = (hashes & ~_POSITION) | grams.astype(np.uint64)  # equal hashes: the leftmost wins
    width = window - GRAM + 1
    # minimum of every `width` neighbours from minima towards both ends of fixed stretches
    padded = np.concatenate([ranked, np.full(-len(ranked) % width, np.uint64(2**64 - 1))]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    place = (np.minimum(back[:n_windows], ahead[width - 1:width - 1 + n_windows]) & _POSITION).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:], [n_windows]]) - 1
    return place[first], first, last, hashes[place[first]]


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals joined where they overlap or touch."""
    if len(starts) == 0:
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[new], reach[np.concatenate([new[1:], [True]])]


def _occurrences(batches: Iterator[pa.RecordBatch], unit: Unit) -> Iterator[pa.RecordBatch]:
    """Anchor occurrences of every text; within a text only the first of several equal contexts.

    Rows with ``known`` are no occurrences but intervals [low, high) that repeat within the text itself.
    """
    names = ["c1", "c2", "anchor", "low", "high", "gram", "known"]
    for batch in batches:
        for row in range(batch.num_rows):
            text = unit.seen(batch.column("text")[row].as_py())
            found = []
            for at in range(0, max(1, len(text) - unit.window + 1), SEGMENT):
                data = np.frombuffer(text, np.uint8)[at:at + SEGMENT + unit.window - 1]
                prefix = prefix_hashes(data)
                place, low, high, gram = anchors(data, prefix, unit.window)
                content = substring_hashes(prefix, low, high + unit.window)
                found.append((place + at, low + at, high + at, gram, content))
            place, low, high, gram, content = (np.concatenate(x) for x in zip(*found))
            if len(place) == 0:
                continue
            _, inverse, first, count = _unique(content)
            twice = count[inverse] > 1
            starts, ends = merged(low[twice], high[twice] + unit.window)
            size = len(first) + len(starts)
            known = np.zeros(size, bool)
            known[len(first):] = True
            columns = [np.concatenate([x[first], y]) for x, y in (
                (place, starts), (low, starts), (high, ends), (gram.view(np.int64), np.zeros(len(starts), np.int64)))]
            ids = [pa.array(np.full(size, batch.column(c)[row].as_py(), np.int64)) for c in ("c1", "c2")]
            yield pa.RecordBatch.from_arrays([*ids, *map(pa.array, columns), pa.array(known)], names)


def _unique(values: np.ndarray):
    found, first, inverse, count = np.unique(values, return_index=True, return_inverse=True, return_counts=True)
    return found, inverse, first, count


def _contexts(batches: Iterator[pa.RecordBatch], unit: Unit) -> Iterator[pa.RecordBatch]:
    """The context of each occurrence; one of a crowded anchor is cut into cells of CELL offsets,
    whose key also holds what all full windows of the cell have in common."""
    for batch in batches:
        for row in range(batch.num_rows):
            text = unit.seen(batch.column("text")[row].as_py())
            out = []
            for o in batch.column("found")[row].as_py():
                if o["known"]:
                    continue
                if not o["crowded"]:
                    out.append((o["gram"], o["low"], text[o["low"]:o["high"] + unit.window], False, o["anchor"] - o["low"]))
                    continue
                anchor, low = o["anchor"], o["low"]
                while low <= o["high"]:
                    cell = (anchor - low) // CELL
                    high = min(o["high"], anchor - cell * CELL)
                    core = text[anchor - cell * CELL:anchor - cell * CELL - CELL + 1 + unit.window]
                    key = hashlib.blake2b(b"%d %d " % (o["gram"], cell) + core, digest_size=8).digest()
                    out.append((int.from_bytes(key, "little", signed=True), low, text[low:high + unit.window], True, anchor - low))
                    low = high + 1
            if out:
                key, low, context, cell, offset = zip(*out)
                ids = [pa.array([batch.column(c)[row].as_py()] * len(out), pa.int64()) for c in ("c1", "c2")]
                yield pa.RecordBatch.from_arrays(
                    [*ids, pa.array(key, pa.int64()), pa.array(low, pa.int64()), pa.array(context, pa.binary()),
                     pa.array(cell), pa.array(offset, pa.int64())], ["c1", "c2", "key", "low", "context", "cell", "offset"])


def _single_windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Each window of a context by itself, as the hash of its content."""
    for batch in batches:
        for row in range(batch.num_rows):
            data = np.frombuffer(batch.column("context")[row].as_py(), np.uint8)
            start = np.arange(len(data) - window + 1)
            hashes = substring_hashes(prefix_hashes(data), start, start + window).view(np.int64)
            fixed = [pa.array(np.full(len(start), batch.column(c)[row].as_py(), np.int64)) for c in ("c1", "c2")]
            yield pa.RecordBatch.from_arrays(
                [*fixed, pa.array(start + batch.column("low")[row].as_py()), pa.array(hashes)],
                ["c1", "c2", "low", "window"])


def _common(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)))


def _reach(parts: list[bytes]) -> list[int]:
    """How far the beginning of each string is shared with any other of them."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    out = [0] * len(parts)
    for i, j in zip(order, order[1:]):
        n = _common(parts[i], parts[j])
        out[i], out[j] = max(out[i], n), max(out[j], n)
    return out


def _trimmed(rows: pd.DataFrame, window: int) -> pd.DataFrame:
    """Contexts of one key cut to what any other of them shares to the left and right of the anchor;
    too short ones hold no repeated window."""
    contexts, offsets = rows["context"].tolist(), rows["offset"].tolist()
    left = _reach([c[:o][::-1] for c, o in zip(contexts, offsets)])
    right = _reach([c[o:] for c, o in zip(contexts, offsets)])
    rows = rows.assign(low=[n + o - a for n, o, a in zip(rows["low"], offsets, left)],
                       context=[c[o - a:o + b] for c, o, a, b in zip(contexts, offsets, left, right)])
    return rows[[a + b >= window for a, b in zip(left, right)]]


def _block_intervals(block: pd.DataFrame, window: int) -> pd.DataFrame:
    """Intervals [low, high) of a block's distinct contexts that repeat, by their suffix array."""
    block = pd.concat([_trimmed(rows, window) for _, rows in block.groupby("key", sort=False)])
    out = []
    # the block's contexts, some suffix arrays' worth at a time; those of one key stay together
    part, size = [], 0
    keys = [rows for _, rows in block.groupby("key", sort=False)]
    for i, rows in enumerate(keys):
        part.append(rows)
        size += sum(map(len, rows["context"]))
        if size >= ARRAY_BYTES or i == len(keys) - 1:
            out.extend(_repeated(pd.concat(part), window))
            part, size = [], 0
    return pd.DataFrame(out, columns=["c1", "c2", "low", "high"], dtype="int64")


def _repeated(rows: pd.DataFrame, window: int) -> Iterator[tuple[int, int, int, int]]:
    contexts = dict.fromkeys(rows["context"])
    number = {c: i for i, c in enumerate(contexts)}
    copies = rows["context"].value_counts()
    shown = repeated_windows(list(contexts), window)
    for c1, c2, low, context in zip(rows["c1"], rows["c2"], rows["low"], rows["context"]):
        # equal after trimming: all windows repeat
        windows = np.ones_like(shown[number[context]]) if copies[context] > 1 else shown[number[context]]
        at = np.flatnonzero(windows)
        starts, ends = merged(at + low, at + low + window)
        yield from ((c1, c2, s, e) for s, e in zip(starts.tolist(), ends.tolist()))


def _kept(batches: Iterator[pa.RecordBatch], unit: Unit) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            text = batch.column("text")[row].as_py().encode()
            spans = batch.column("spans")[row].as_py()
            starts, ends = merged(np.array([s["low"] for s in spans]), np.array([s["high"] for s in spans]))
            starts, ends = unit.spans(text, starts, ends)
            kept, at = [], 0
            for s, e in zip(starts.tolist(), ends.tolist()):
                kept.append(text[at:s])
                at = e
            kept = b"".join([*kept, text[at:]])
            ids = [pa.array([batch.column(c)[row].as_py()], pa.int64()) for c in ("c1", "c2")]
            yield pa.RecordBatch.from_arrays(
                [*ids, pa.array([len(text) - len(kept)], pa.int64()), pa.array([len(starts)], pa.int64()),
                 pa.array([hashlib.sha256(kept).hexdigest()]), pa.array([kept.decode("utf-8", "ignore")], pa.string())],
                ["c1", "c2", "n_removed", "n_spans", "kept_sha256", "kept"])


def _intervals(affected: DataFrame, unit: Unit) -> DataFrame:
    """(c1, c2, low, high): windows of the occurrences' contexts that repeat in other texts or places."""
    contexts = written(affected.select("c1", "c2", "text", "found").mapInArrow(
        partial(_contexts, unit=unit), "c1 long, c2 long, key long, low long, context binary, cell boolean, offset long"), "contexts")
    contexts = contexts.withColumn("content", F.xxhash64("context"))
    # equal contexts settle each other; one of them stays as a partner for the different ones
    copies = contexts.groupBy("key", "content").agg(F.count("*").alias("copies"))
    settled = (contexts.select("key", "content", "c1", "c2", "low", (F.col("low") + F.length("context")).alias("high"))
               .join(copies.filter("copies > 1"), ["key", "content"], "left_semi").select("c1", "c2", "low", "high"))
    per_key = copies.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    several = written(contexts.join(per_key, "key").groupBy("key", "content", "members").agg(
        F.min(F.struct("c1", "c2", "low", "offset")).alias("at"),
        F.first("context").alias("context"), F.first("cell").alias("cell"))
        .select("key", "members", "at.*", "context", "cell"), "shared-contexts")
    crowded = F.col("cell") & (F.col("members") > BLOCK_MEMBERS)
    total = several.filter(~crowded).agg(F.sum(F.length("context"))).first()[0] or 0
    block = F.pmod(F.xxhash64("key"), F.lit(max(1, int(total // BLOCK_BYTES))))
    in_block = lambda block: _block_intervals(block, unit.window)
    compared = (several.filter(~crowded).withColumn("block", block)
                .select("block", "key", "c1", "c2", "low", "offset", "context").groupBy("block")
                .applyInPandas(in_block, "c1 long, c2 long, low long, high long"))
    windows = several.filter(crowded).mapInArrow(partial(_single_windows, window=unit.window), "c1 long, c2 long, low long, window long")
    often = windows.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").select("window")
    single = (windows.join(often, "window", "left_semi")
              .select("c1", "c2", "low", (F.col("low") + F.lit(unit.window)).alias("high")))
    return settled.unionByName(compared).unionByName(single)


def _with_class(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, text and the two hashes that identify equal texts."""
    text = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("key"), text.alias("text"),
                       F.xxhash64(text).alias("c1"), F.xxhash64(F.lit(1), text).alias("c2"))


def _outcome(rows: DataFrame, unit: Unit) -> DataFrame:
    """What each class that loses bytes loses and keeps; ``kept`` is text, without characters that lost a byte."""
    long = F.octet_length("text") >= unit.shortest
    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")
    classes = written(rows.filter(long).select("key", "c1", "c2", n_bytes).groupBy("c1", "c2").agg(
        F.count("*").alias("copies"), F.min("key").alias("rep"), F.first("n_bytes").alias("n_bytes")), "classes")
    occurrences = written(rows.filter(long).select("c1", "c2", "text").mapInArrow(
        partial(_occurrences, unit=unit), "c1 long, c2 long, anchor long, low long, high long, gram long, known boolean"), "occurrences")
    spot = F.xxhash64("c1", "c2", "low")
    grams = (occurrences.filter(~F.col("known")).groupBy("gram")
             .agg(F.min(spot).alias("least"), F.max(spot).alias("most")).filter("least < most").select("gram"))
    shared = written(occurrences.filter(~F.col("known")).join(grams, "gram", "left_semi").distinct(), "shared")
    crowd = shared.groupBy("gram").agg((F.count("*") > BLOCK_MEMBERS).alias("crowded"))
    known = occurrences.filter("known").distinct()
    places = shared.join(crowd, "gram").unionByName(known.withColumn("crowded", F.lit(False)))
    lists = places.groupBy("c1", "c2").agg(
        F.collect_list(F.struct("anchor", "low", "high", "gram", "known", "crowded")).alias("found"))
    lists = lists.join(classes.select("c1", "c2", "copies", "rep"), ["c1", "c2"])
    affected = written(
        rows.join(lists.withColumnsRenamed({"c1": "d1", "c2": "d2"}),
                  (F.col("c1") == F.col("d1")) & (F.col("c2") == F.col("d2")) & F.col("key").eqNullSafe(F.col("rep")))
        .select("c1", "c2", "text", "found", "copies"), "affected").dropDuplicates(["c1", "c2"])
    spans = _intervals(affected, unit).unionByName(known.select("c1", "c2", "low", "high"))
    spans = spans.groupBy("c1", "c2").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    parted = (affected.filter("copies = 1").select("c1", "c2", "text").join(spans, ["c1", "c2"])
              .mapInArrow(partial(_kept, unit=unit), "c1 long, c2 long, n_removed long, n_spans long, kept_sha256 string, kept string"))
    twice = classes.filter("copies > 1")
    if unit.words:  # whether a text has a window at all shows in its occurrences
        twice = twice.join(occurrences.select("c1", "c2").distinct(), ["c1", "c2"], "left_semi")
    whole = twice.select(
        "c1", "c2", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.lit(hashlib.sha256(b"").hexdigest()).alias("kept_sha256"), F.lit("").alias("kept"))
    return written(parted.unionByName(whole), "outcome")


def repeated_strings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key``, n_bytes, n_removed, n_spans, kept_sha256, ``text``.

    Removed is each byte covered by a 400-byte string that also starts anywhere else in the
    texts (UTF-8), the same one included; strings are judged on the input.  A null text counts as
    empty; texts under 400 bytes keep everything.  A text of 400 bytes or more that occurs
    twice is removed altogether, repeated rows included.  ``text`` is what is left of it, less the characters
    that lost a byte ('' for a null text).  An empty table has no rows.  Other columns play no part.
    """
    rows = _with_class(docs, key, text)
    sha256 = F.sha2(F.col("text").cast("binary"), 256)
    return rows.join(_outcome(rows, BYTES), ["c1", "c2"], "left").select(
        F.col("key").alias(key), F.octet_length("text").cast("long").alias("n_bytes"), F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept_sha256", sha256).alias("kept_sha256"),
        F.coalesce("kept", "text").alias(text))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: Unit = BYTES) -> DataFrame:
    """The rows with ``text`` reduced to its kept bytes, all other columns as they are.

    Removed are windows of ``unit`` that also stand elsewhere; windows of words repeat whatever white space parts them.
    A character of which a byte is removed goes altogether.  A null text stays null.
    """
    outcome = _outcome(_with_class(docs, key, text), unit)
    own = F.coalesce(F.col(text), F.lit(""))
    kept = outcome.select(F.col("c1").alias("_c1"), F.col("c2").alias("_c2"), F.col("kept").alias("_kept"))
    joined = docs.join(kept, (F.xxhash64(own) == F.col("_c1")) & (F.xxhash64(F.lit(1), own) == F.col("_c2")), "left")
    new = F.when(F.col("_kept").isNull(), F.col(text)).otherwise(F.col("_kept"))
    return joined.select(*[(new.alias(c) if c == text else F.col(c)) for c in docs.columns])
