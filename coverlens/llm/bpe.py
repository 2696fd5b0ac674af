"""Byte-level BPE encoding and decoding by replaying merges over a whole batch of words at once.

An inverted index leads from each possible merge to the places where its pair stands; the
merge of lowest rank is applied at all its places before the next, and only the two
neighbours of each place get new index entries.  A word that occurs again is not encoded again.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens.llm.common import small_batches

CACHE_WORDS = 150_000      # words of one generation remembered per Python worker; two generations are kept
CACHE_CHARACTERS = 64      # longer words are not remembered
BATCH_CHARACTERS = 2_000_000  # texts are encoded together up to this length


def load_ranks(path: str) -> dict[bytes, int]:
    """The rank file: one token (base64) and its rank, which is its id, per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class MergeReplay:
    """Encodes words (bytes) to ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.token[i] = token
        self.byte = [ranks[bytes([b])] for b in range(256)]
        self.merged: dict[tuple[int, int], int] = {}
        # the merge of every two single bytes, or -1
        self.byte_pair = [ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]

    def merge_of(self, left: int, right: int) -> int:
        """Id of the two tokens joined, or -1."""
        found = self.merged.get((left, right))
        if found is None:
            found = self.merged[left, right] = self.ranks.get(self.token[left] + self.token[right], -1)
        return found

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word; a word that is a token itself is that token."""
        ranks, merge_of, byte, byte_pair = self.ranks, self.merge_of, self.byte, self.byte_pair
        out: list[list[int] | None] = [[ranks[w]] if w in ranks else None for w in words]
        symbol: list[int] = []   # token at each place, -1 where it was merged into the one before
        word_ends: list[int] = []
        starts: list[tuple[int, int]] = []
        places: dict[int, list[int]] = defaultdict(list)
        for i, word in enumerate(words):
            if out[i] is not None or not word:
                out[i] = out[i] or []
                continue
            place = len(symbol)
            starts.append((i, place))
            symbol += [byte[b] for b in word]
            left = word[0]
            for right in word[1:]:
                rank = byte_pair[left << 8 | right]
                if rank >= 0:
                    places[rank].append(place)
                place += 1
                left = right
            word_ends.append(place)
        after = list(range(1, len(symbol) + 1))      # next living place in the same word, or -1
        before = list(range(-1, len(symbol) - 1))
        for i, place in starts:
            before[place] = -1
        for place in word_ends:
            after[place] = -1

        queue = list(places)
        heapq.heapify(queue)
        while queue:
            rank = heapq.heappop(queue)
            todo = places.pop(rank, None)
            if todo is None:
                continue
            todo.sort()
            sooner = False
            for n, place in enumerate(todo):
                right = after[place]
                if right < 0 or symbol[place] < 0 or merge_of(symbol[place], symbol[right]) != rank:
                    continue  # a neighbour was merged meanwhile
                symbol[place], symbol[right] = rank, -1
                beyond, behind = after[right], before[place]
                after[place] = beyond
                if beyond >= 0:
                    before[beyond] = place
                    new = merge_of(rank, symbol[beyond])
                    if new >= 0:
                        if new not in places:
                            heapq.heappush(queue, new)
                        places[new].append(place)
                        sooner = new < rank
                if behind >= 0:
                    new = merge_of(symbol[behind], rank)
                    if new >= 0:
                        if new not in places:
                            heapq.heappush(queue, new)
                        places[new].append(behind)
                        sooner = sooner or new < rank
                if sooner:  # a merge of lower rank became possible: it comes first
                    if rank not in places:
                        heapq.heappush(queue, rank)
                    places[rank].extend(todo[n + 1:])
                    break
        for i, place in starts:
            ids = []
            while place >= 0:
                ids.append(symbol[place])
                place = after[place]
            out[i] = ids
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class TextEncoder:
    """Encodes texts; the words of many texts go through one replay."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.replay, self.split = MergeReplay(ranks), regex.compile(pattern).findall
        # word -> ids as little-endian 32-bit integers; words unused for two generations are forgotten
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode_many(self, texts: list[str]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        missing = set().union(*split).difference(known)
        again = missing.intersection(older)
        known.update((w, older[w]) for w in again)
        fresh = list(missing - again)
        coded = self.replay.encode([w.encode("utf-8", "surrogatepass") for w in fresh])
        known.update((w, struct.pack(f"<{len(ids)}I", *ids)) for w, ids in zip(fresh, coded))
        out = [b"".join(map(known.__getitem__, words)) for words in split]
        for w in fresh:
            if len(w) > CACHE_CHARACTERS:
                del known[w]
        return out


_ENCODERS: dict[tuple[str, str], TextEncoder] = {}


def _encoder(name: str, ranks: Broadcast, pattern: str) -> TextEncoder:
    """One encoder per Python worker, rank table and pattern: later tasks find the words of earlier ones."""
    if (name, pattern) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name, pattern] = TextEncoder(ranks.value, pattern)
    return _ENCODERS[name, pattern]


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text",
                     keep_ids: bool = False) -> DataFrame:
    """One row per input row: ``key``, n_tokens, ids_sha256, decoded_sha256 (and ids, a binary, if kept).

    A null or empty text has no tokens and the hashes of empty strings.  Whole texts are
    encoded, however long; every row by itself, so rows may repeat.  Other columns play no part.
    """
    session = docs.sparkSession
    small_batches(session)
    table = load_ranks(rank_file)
    name = hashlib.sha256(repr(sorted(table.items())).encode()).hexdigest()
    ranks = session.sparkContext.broadcast(table)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["key"]
    schema = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(name, ranks, pattern)
        for batch in batches:
            keys, column = batch.column("key"), batch.column("text")
            at = 0
            while at < len(column):
                texts, size = [], 0
                while at + len(texts) < len(column) and size < BATCH_CHARACTERS:
                    texts.append(column[at + len(texts)].as_py() or "")
                    size += len(texts[-1])
                coded = coder.encode_many(texts)
                hashes = lambda parts: [hashlib.sha256(p).hexdigest() for p in parts]
                decoded = hashes(coder.replay.decode(np.frombuffer(ids, dtype="<u4").tolist()) for ids in coded)
                columns = [keys.slice(at, len(texts)), pa.array([len(ids) // 4 for ids in coded], pa.int64()),
                           pa.array(hashes(coded)), pa.array(decoded)]
                names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    columns, names = [*columns, pa.array(coded, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)
                at += len(texts)

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
