"""Removal of long word passages that also stand elsewhere, found by suffix automata over reference shards.

Every window of WINDOW words has an anchor: the leftmost of its GRAM-word strings with the smallest
hash.  Equal windows have equal anchors at the same offset, so windows meet where their anchors do.
The windows of one anchor occurrence form a context.  An anchor whose occurrences all have one context
matches as a whole.  Distinct contexts of the other anchors that occur again are dealt to shards by
anchor.  A reference shard is sent to every part of the contexts streamed against it and becomes a suffix
automaton there, cut to the strings that occur often enough: the matching statistics (the longest
match that ends at each word) show the passages.

An anchor with very many distinct contexts is dealt by finer keys, at last by single windows, so
that a shard stays bounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens.llm.common import mix64, prefix_hashes, running_sums, substring_hashes, written

WINDOW = 35
GRAM = 12              # words of an anchor
CELL = 6               # offsets per finer key
MEMBERS = 200          # distinct contexts of an anchor or finer key beyond which it is dealt anew
SHARD_WORDS = 40_000   # words of one shard, about
SEGMENT_BYTES = 1 << 22  # bytes of a text hashed together
SEGMENT = 1 << 20        # windows of a text looked at together

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLACE = np.random.default_rng(13).integers(1, 2**63, GRAM, dtype=np.uint64) | np.uint64(1)
_LOW_BITS = np.uint64((1 << 24) - 1)
_NO_KEY = -(2**63)

OCCURRENCES = "array<struct<place:int,low:int,high:int,gram:bigint,content:bigint>>"


# --- words and anchors --------------------------------------------------------------------

def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text's bytes."""
    edge = np.diff(np.concatenate([[True], _SPACE[data], [True]]).view(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    out, i = [np.zeros(0, np.uint64)], 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT_BYTES, side="right")))
        prefix = prefix_hashes(data[starts[i]:ends[j - 1]])
        out.append(substring_hashes(prefix, starts[i:j] - starts[i], ends[i:j] - starts[i]))
        i = j
    return np.concatenate(out)


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from minima of twice as many each time."""
    spanned = 1
    while 2 * spanned <= width:
        values = np.minimum(values[:-spanned], values[spanned:])
        spanned *= 2
    rest = width - spanned
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def occurrences(codes: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(place, low, high, gram, content) of each run of windows of one anchor occurrence: the anchor's place, the first
    and the last window's start, and hashes of the anchor and of all words from the first window's to the last one's."""
    found = [tuple(np.zeros(0, np.int64) for _ in range(5))]
    for at in range(0, len(codes) - window + 1, SEGMENT):
        part = codes[at:at + SEGMENT + window - 1]
        grams = np.zeros(len(part) - GRAM + 1, np.uint64)
        for k in range(GRAM):
            grams += part[k:k + len(grams)] * _PLACE[k]
        grams = mix64(grams)
        ranked = (grams & ~_LOW_BITS) | np.arange(len(grams), dtype=np.uint64)  # equal hashes: the leftmost wins
        place = (_sliding_minimum(ranked, window - GRAM + 1) & _LOW_BITS).astype(np.int64)
        low = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        high = np.concatenate([low[1:], [len(place)]]) - 1
        content = substring_hashes(running_sums(part), low, high + window)
        found.append((place[low] + at, low + at, high + at, grams[place[low]].view(np.int64), content.view(np.int64)))
    return tuple(np.concatenate(columns) for columns in zip(*found))


def _scanned(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The anchor occurrences of each text."""
    for batch in batches:
        lists = []
        for value in batch.column("text"):
            data = np.frombuffer(value.as_py().encode(), np.uint8)
            lists.append(occurrences(word_codes(data, *word_bounds(data)), window))
        offsets = np.concatenate([[0], np.cumsum([len(x[0]) for x in lists])]).astype(np.int32)
        place, low, high, gram, content = (np.concatenate(columns) for columns in zip(*lists)) if lists else [np.zeros(0, np.int64)] * 5
        structs = pa.StructArray.from_arrays(
            [pa.array(place.astype(np.int32)), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)), pa.array(gram), pa.array(content)],
            ["place", "low", "high", "gram", "content"])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("k", "c1", "c2", "ours")), pa.ListArray.from_arrays(offsets, structs)],
            ["k", "c1", "c2", "ours", "found"])


# --- suffix automata ------------------------------------------------------------------------

class SuffixAutomaton:
    """All substrings of the sequences added, with the number of places where each occurs."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.link) - 1

    def _split(self, before: int, symbol: int, state: int) -> int:
        """A state for the strings of ``state`` that are one longer than ``before``'s longest, or shorter."""
        clone = self._state(self.length[before] + 1, dict(self.next[state]), self.link[state])
        self.link[state] = clone
        while before != -1 and self.next[before].get(symbol) == state:
            self.next[before][symbol] = clone
            before = self.link[before]
        return clone

    def _extended(self, last: int, symbol: int) -> int:
        known = self.next[last].get(symbol)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, symbol, known)
        new = self._state(self.length[last] + 1, {}, 0)
        while last != -1 and symbol not in self.next[last]:
            self.next[last][symbol] = new
            last = self.link[last]
        if last != -1:
            known = self.next[last][symbol]
            self.link[new] = known if self.length[known] == self.length[last] + 1 else self._split(last, symbol, known)
        return new

    def add(self, symbols: list[int], places: int) -> None:
        """One more sequence, which stands at ``places`` places."""
        last = 0
        for symbol in symbols:
            last = self._extended(last, symbol)
            self.count[last] += places

    def frequent(self, least: int, length: int) -> Matcher | None:
        """The automaton cut to the substrings that occur at ``least`` places; None if none of them has ``length`` symbols."""
        count = self.count
        for state in np.argsort(self.length, kind="stable")[:0:-1].tolist():  # longest first, without the root
            count[self.link[state]] += count[state]
        kept = [0] + [s for s in range(1, len(count)) if count[s] >= least]
        if max(self.length[s] for s in kept) < length:
            return None
        frequent = {s: {symbol: t for symbol, t in self.next[s].items() if count[t] >= least} for s in kept}
        return Matcher(frequent, self.link, self.length)


class Matcher:
    """Matching statistics against an automaton: per state its edges, suffix link and longest string's length."""

    def __init__(self, edges: dict[int, dict[int, int]], links: list[int], lengths: list[int]) -> None:
        self.edges, self.links, self.lengths = edges, links, lengths

    def spans(self, symbols: list[int], threshold: int) -> list[list[int]]:
        """Maximal spans [start, end) covered by matches of at least ``threshold`` symbols."""
        state, matched, out = 0, 0, []
        edges, links, lengths = self.edges, self.links, self.lengths
        for i, symbol in enumerate(symbols):
            while state and symbol not in edges[state]:
                state = links[state]
                matched = lengths[state]
            state = edges[state].get(symbol, 0)
            matched = matched + 1 if state else 0
            if matched >= threshold:
                if out and i - matched + 1 <= out[-1][1]:
                    out[-1][1] = i + 1
                else:
                    out.append([i - matched + 1, i + 1])
        return out


def _matched(part: pd.DataFrame, least: int, window: int) -> pd.DataFrame:
    """Spans (in words) of the streamed pieces that the automaton of their reference shard matches."""
    automaton, out = SuffixAutomaton(), []
    known = part[part["places"] > 0]
    for codes, places in zip(known["codes"], known["places"].tolist()):
        automaton.add(np.frombuffer(codes, np.uint64).tolist(), places)
    matcher = automaton.frequent(least, window)
    if matcher is not None:
        stream = part[part["streamed"]]
        for key, sub, codes in zip(stream["key"].tolist(), stream["sub"].tolist(), stream["codes"]):
            out.extend((key, sub, *span) for span in matcher.spans(np.frombuffer(codes, np.uint64).tolist(), window))
    return pd.DataFrame(out, columns=["key", "sub", "start", "end"], dtype="int64")


# --- contexts ---------------------------------------------------------------------------------

_CUT = "gram long, content long, places long, ours boolean, at long, key long, codes binary"
_CUT_NAMES = ["gram", "content", "places", "ours", "at", "key", "codes"]
_CUT_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]


def _pieces(gram: int, place: int, low: int, high: int, codes: np.ndarray, window: int) -> Iterator[tuple[int, int, bytes]]:
    """A context cut by the anchor's offset into cells: (key, low, codes); what all full windows of a cell share is in its key."""
    while low <= high:
        cell = (place - low) // CELL
        start = place - cell * CELL
        last = min(high, start)
        core = codes[start:start - CELL + 1 + window]
        key = hashlib.blake2b(b"%d %d " % (gram, cell) + core.tobytes(), digest_size=8).digest()
        yield int.from_bytes(key, "little", signed=True), low, codes[low:last + window].tobytes()
        low = last + 1


def _contexts(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(gram, content, at, places, ours, key, codes): each listed context, that of a crowded anchor in cells; at counts from its low."""
    for batch in batches:
        for row in range(batch.num_rows):
            data = np.frombuffer(batch.column("text")[row].as_py().encode(), np.uint8)
            codes, out = word_codes(data, *word_bounds(data)), []
            for o in batch.column("found")[row].as_py():
                known = (o["gram"], o["content"], o["places"], o["ours"])
                if not o["crowded"]:
                    out.append((*known, 0, o["gram"], codes[o["low"]:o["high"] + window].tobytes()))
                    continue
                for key, low, part in _pieces(o["gram"], o["place"], o["low"], o["high"], codes, window):
                    out.append((*known, low - o["low"], key, part))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _CUT_TYPES)], _CUT_NAMES)


def _single_windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Each window of a piece by itself; its key is the hash of its words."""
    for batch in batches:
        for row in range(batch.num_rows):
            codes = np.frombuffer(batch.column("codes")[row].as_py(), np.uint64)
            start = np.arange(len(codes) - window + 1)
            hashes = substring_hashes(running_sums(codes), start, start + window).view(np.int64)
            known = [pa.array([batch.column(c)[row].as_py()] * len(start), t) for c, t in zip(_CUT_NAMES[:4], _CUT_TYPES)]
            yield pa.RecordBatch.from_arrays([*known, pa.array(start + batch.column("at")[row].as_py()), pa.array(hashes),
                                              pa.array([codes[s:s + window].tobytes() for s in start], pa.binary())], _CUT_NAMES)


def _shared_pieces(texts: DataFrame, known: DataFrame, least: int, window: int) -> tuple[DataFrame, DataFrame]:
    """(pieces, links): distinct pieces (key, sub, codes, places, ours) of keys that several share, and which
    part (at) of which context (gram, content) each is.

    ``known`` holds the distinct contexts to be compared: gram, content, places, ours, one (where it stands), crowded.
    """
    lists = known.groupBy("one.c1", "one.c2", "one.k").agg(F.collect_list(
        F.struct("one.place", "one.low", "one.high", "gram", "content", "places", "ours", "crowded")).alias("found"))
    # one row of each text in question, by its class and key
    cut = written(texts.join(lists, ["c1", "c2", "k"]).dropDuplicates(["c1", "c2", "k"]).select("text", "found")
                  .mapInArrow(partial(_contexts, window=window), _CUT), "contexts")

    def by_key(cut: DataFrame) -> DataFrame:
        """Distinct pieces, and how many a key has; those of a key with too few places go."""
        pieces = cut.groupBy("key", F.xxhash64("codes").alias("sub")).agg(
            F.first("codes").alias("codes"), F.sum("places").alias("places"), F.max("ours").alias("ours"))
        of_key = pieces.groupBy("key").agg(F.count("*").alias("members"), F.sum("places").alias("n")).filter(F.col("n") >= least)
        return pieces.join(of_key.drop("n"), "key")

    link = lambda cut: cut.select("gram", "content", "at", "key", F.xxhash64("codes").alias("sub"))
    whole, cells = cut.filter("key = gram"), cut.filter("key <> gram")
    pieces, links = whole.select("key", F.xxhash64("codes").alias("sub"), "codes", "places", "ours"), link(whole)
    if not cells.isEmpty():
        finer = written(by_key(cells), "cells")
        crowded = finer.filter(F.col("members") > MEMBERS).select("key").distinct()
        links = links.unionByName(link(cells))
        pieces = pieces.unionByName(finer.filter(F.col("members") <= MEMBERS).drop("members"))
        if not crowded.isEmpty():
            single = written(cells.join(crowded, "key", "left_semi").select(*_CUT_NAMES)
                             .mapInArrow(partial(_single_windows, window=window), _CUT), "windows")
            links = links.unionByName(link(single))
            pieces = pieces.unionByName(by_key(single).drop("members"))
    return pieces, links


def _matches(pieces: DataFrame, least: int, window: int) -> DataFrame:
    """(key, sub, start, end): spans of the pieces that stand at ``least`` reference places, by the automata of their shards."""
    total = pieces.agg(F.sum(F.length("codes"))).first()[0] or 0
    shards = max(1, total // (8 * SHARD_WORDS))
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    # a reference shard is sent to every part of what is streamed against it
    parts = pieces.filter("ours AND places = 0").groupBy("shard").agg(
        F.ceil(F.sum(F.length("codes")) / (8 * SHARD_WORDS)).cast("int").alias("parts")).filter("parts > 1")
    parts = F.coalesce("parts", F.lit(1)), pieces.join(parts, "shard", "left")
    own = F.pmod(F.xxhash64("key", "sub"), parts[0]).cast("int")
    dealt = parts[1].withColumn("part", F.explode(F.when(F.col("places") > 0, F.sequence(F.lit(0), parts[0] - 1)).otherwise(F.array(own))))
    dealt = dealt.withColumn("streamed", F.col("ours") & (F.col("part") == own))
    match = lambda part: _matched(part, least, window)
    return (dealt.select("shard", "part", "key", "sub", "codes", "places", "streamed").groupBy("shard", "part")
            .applyInPandas(match, "key long, sub long, start long, end long"))


# --- outcome ------------------------------------------------------------------------------------

def _joined(spans: list[dict]) -> list[list[int]]:
    """Spans joined where they overlap or touch, in order."""
    out: list[list[int]] = []
    for start, end in sorted((s["low"], s["high"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """k, n_words, n_removed, spans, kept_sha256, kept of each text; a null list of spans is an empty one."""
    for batch in batches:
        rows = []
        for key, text, spans in zip(batch.column("k").to_pylist(), batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            words, out, at = text.encode().split(), [], 0
            joined = _joined(spans or [])
            for low, high in joined:
                out += words[at:low]
                at = high
            kept = b" ".join(out + words[at:])
            rows.append((key, len(words), sum(high - low for low, high in joined), [{"low": low, "high": high} for low, high in joined],
                         hashlib.sha256(kept).hexdigest(), kept.decode()))
        columns = list(zip(*rows)) or [()] * len(_FINISHED)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _FINISHED.values())], list(_FINISHED))


_SPANS = "array<struct<low:bigint,high:bigint>>"
_FINISHED = {"k": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "spans": pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())])),
             "kept_sha256": pa.string(), "kept": pa.string()}


def _rows(docs: DataFrame, key: str, text: str, ours: bool) -> DataFrame:
    text = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_NO_KEY)).alias("k"), text.alias("text"), F.lit(ours).alias("ours"),
                       F.xxhash64(text).alias("c1"), F.xxhash64(F.lit(1), text).alias("c2"))


def _spans(docs: DataFrame, key: str, text: str, window: int, reference: DataFrame | None) -> DataFrame:
    """(c1, c2, spans): what each text that loses words loses; spans may overlap."""
    own = _rows(docs, key, text, True)
    rows = own if reference is None else own.unionByName(_rows(reference, key, text, False))
    least = 2 if reference is None else 1  # places of the reference at which a window that goes must stand
    scanned = written(rows.mapInArrow(partial(_scanned, window=window), "k long, c1 long, c2 long, ours boolean, "
                                      f"found {OCCURRENCES}"), "scanned")
    counted = F.lit(1) if reference is None else F.when(F.col("ours"), 0).otherwise(1)
    classes = written(scanned.filter(F.size("found") > 0).groupBy("c1", "c2").agg(
        F.sum(counted).alias("copies"), F.max("ours").alias("ours"), F.min("k").alias("k")), "classes")
    # anchors that stand at enough places
    enough = scanned.select(counted.alias("n"), F.explode("found.gram").alias("gram")).groupBy("gram").agg(F.sum("n").alias("n"))
    enough = written(enough.filter(F.col("n") >= least).select("gram"), "grams")
    # equal texts are looked at once
    places = scanned.select("c1", "c2", "k", F.explode("found").alias("o")).select("c1", "c2", "k", "o.*").join(enough, "gram", "left_semi")
    places = written(places.join(classes, ["c1", "c2", "k"]).distinct(), "places")
    distinct = places.groupBy("gram", "content").agg(
        F.sum("copies").alias("places"), F.max("ours").alias("ours"), F.min(F.struct("c1", "c2", "k", "place", "low", "high")).alias("one"))
    distinct = written(distinct, "distinct")
    several = distinct.groupBy("gram").agg(F.max("ours").alias("any"), F.count("*").alias("contexts"))
    known = distinct.join(several.filter("any"), "gram").withColumn("crowded", F.col("contexts") > MEMBERS)
    # the words around an anchor that has one context match as a whole; others are compared
    whole = known.filter(F.col("contexts") == 1).filter(F.col("places") >= least).select(
        "gram", "content", F.lit(0).cast("long").alias("start"), (F.col("one.high") - F.col("one.low") + F.lit(window)).cast("long").alias("end"))
    pieces, links = _shared_pieces(rows.select("c1", "c2", "k", "text"), known.filter("contexts > 1"), least, window)
    found = _matches(pieces, least, window).join(links, ["key", "sub"]).select(
        "gram", "content", (F.col("at") + F.col("start")).alias("start"), (F.col("at") + F.col("end")).alias("end"))
    found = written(found.unionByName(whole), "matches")
    spans = places.filter("ours").join(found, ["gram", "content"]).select(
        "c1", "c2", F.struct((F.col("low") + F.col("start")).alias("low"), (F.col("low") + F.col("end")).alias("high")).alias("span"))
    return written(spans.groupBy("c1", "c2").agg(F.collect_set("span").alias("spans")), "spans")


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                      reference: DataFrame | None = None) -> DataFrame:
    """One row per input row: ``key``, n_words, n_removed, spans (low, high in words), kept_sha256, ``text``.

    ``text`` holds the kept words joined by one space, and kept_sha256 is its digest.

    Removed is each word covered by a window of ``window`` words that also starts anywhere else in the texts, the same one
    included; with a ``reference`` (a table of the same columns), each word covered by a window that stands in it.
    Windows are judged on the input.  A null text counts as empty; texts of fewer words keep all of them.  A text of that many words
    that occurs twice goes altogether, repeated rows included.  Keys are integers or null.  An empty table has no rows;
    other columns play no part.
    """
    spans = _spans(docs, key, text, window, reference)
    rows = _rows(docs, key, text, True).join(spans, ["c1", "c2"], "left").select("k", "text", "spans")
    finished = rows.mapInArrow(_finished, f"k long, n_words long, n_removed long, spans {_SPANS}, kept_sha256 string, kept string")
    return finished.select(F.when(F.col("k") != _NO_KEY, F.col("k")).alias(key), "n_words", "n_removed", "spans", "kept_sha256", F.col("kept").alias(text))


def without_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                     reference: DataFrame | None = None) -> DataFrame:
    """The rows, those that lose words with ``text`` reduced to the kept ones, joined by one space; other columns as they are."""
    spans = _spans(docs, key, text, window, reference).select(F.col("c1").alias("_c1"), F.col("c2").alias("_c2"), F.col("spans").alias("_spans"))
    own = F.coalesce(F.col(text), F.lit(""))
    joined = docs.join(spans, (F.xxhash64(own) == F.col("_c1")) & (F.xxhash64(F.lit(1), own) == F.col("_c2")), "left")
    kept = F.when(F.col("_spans").isNotNull(), F.pandas_udf(_kept_words, "string")(own, F.col("_spans"))).otherwise(F.col(text))
    return joined.select(*[(kept.alias(c) if c == text else F.col(c)) for c in docs.columns])


def _kept_words(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """The words outside the spans, joined by one space; None where there are no spans."""
    out: list[str | None] = []
    for text, found in zip(texts, spans):
        if found is None:
            out.append(None)
            continue
        words, kept, at = text.encode().split(), [], 0
        for low, high in _joined(list(found)):
            kept += words[at:low]
            at = high
        out.append(b" ".join(kept + words[at:]).decode())
    return pd.Series(out, dtype=object)


def oracle_sql() -> str:
    """The query's rows by windows written out as text."""
    return rf"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + {WINDOW - 1}], ' ')) AS h
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM texts)),
repeated AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS pos
         FROM (SELECT doc_id, i, unnest(range(0, {WINDOW})) AS j FROM windows WHERE h IN (FROM repeated))),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM texts),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT t.doc_id, len(t.ws) AS n_words, len(t.ws) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256, coalesce(k.text, '') AS text
FROM texts t LEFT JOIN kept k USING (doc_id)"""
