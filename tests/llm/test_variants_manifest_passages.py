"""Spelling variants, the Merkle manifest and passage removal against plain implementations, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from coverlens.llm import automata, merkle, spelling
from tests.llm.data import EDGE_ROWS, LONG, edge_docs, empty_docs, prose

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
EMPTY = hashlib.sha256(b"").hexdigest()


# --- spelling variants ------------------------------------------------------------------------

def near(a, b):
    """Exactly one inserted, deleted or replaced code point apart."""
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


word_lists = st.lists(st.text("abé", min_size=1, max_size=7), min_size=1, max_size=40, unique=True)


@settings(max_examples=200, deadline=None)
@given(word_lists, st.text("abé", min_size=1, max_size=7))
def test_scan_of_a_sorted_list(words, query):
    words = sorted(words)
    lcps = [0] + [spelling._common(x, y) for x, y in zip(words, words[1:])]
    assert spelling.one_edit_apart(query, words, lcps, 0) == [w for w in words if near(w, query)]


@pytest.mark.parametrize("members", [400, 3])
def test_near_pairs(spark, members):
    rng = random.Random(11)
    words = sorted({"".join(rng.choice("abcß") for _ in range(rng.randint(2, 8))) for _ in range(700)} | {"x" * 400, "x" * 401, "y" + "x" * 400})
    got = {(r["u"], r["v"]) for r in spelling.near_pairs(spark.createDataFrame([(w,) for w in words], "word string"), members).collect()}
    assert got == {(a, b) for a in words for b in words if near(a, b)}


def variants(counts, factor=2):
    beside = {w: [x for x in counts if near(w, x)] for w in counts}
    best = {w: min(beside[w], key=lambda x: (-counts[x], x), default=None) for w in counts}
    form = {w: b if b is not None and counts[b] >= factor * counts[w] else None for w, b in best.items()}
    out = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(beside[w]), counts.get(form[w])))
    return out


def test_forms_ties_and_chains(spark):
    counts = {"abcde": 3, "abcdf": 6, "abcdg": 6, "abcxg": 12, "abyxg": 24, "zbyxg": 47, "lonely": 4, "éééé1": 3}
    rows = spelling.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in rows} == variants(counts)
    got = {r["word"]: r for r in rows}
    assert (got["abcde"]["form"], got["abcde"]["root"]) == ("abcdf", "abcdf")  # of two forms as frequent the smaller
    assert (got["abcdg"]["root"], got["abyxg"]["form"]) == ("abyxg", None)     # 47 is below twice 24


def test_vocabulary(spark):
    texts = {i: prose(i, 40) + " ÀÉ×ÿàb Straße naïve-Naïve word_" + "Kakalo" * (i % 3) for i in range(60)}
    counts = Counter()
    for key, text in texts.items():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{key}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    got = {r["word"]: r["n"] for r in spelling.vocabulary(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def test_spelling_edges(spark, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED_WORDS", 10)
    words = spelling.vocabulary(edge_docs(spark))
    got = {r["word"]: r["n"] for r in words.collect()}
    assert got == {r["word"]: r["n"] for r in spelling.vocabulary(edge_docs(spark).select("doc_id", "text")).collect()} and max(got.values()) > 5
    assert spelling.spelling_variants(words).count() == len(got)
    assert spelling.spelling_variants(spelling.vocabulary(empty_docs(spark))).collect() == []


# --- manifest -----------------------------------------------------------------------------------

def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*(row[c] for c in merkle.FIELDS[:4]), text)))


def tree(level):
    """Root, and per leaf its siblings to the left and right on every level."""
    place, paths = list(range(len(level))), [[] for _ in level]
    while len(level) > 1:
        for k, i in enumerate(place):
            run = level[i // 3 * 3:i // 3 * 3 + 3]
            paths[k].append((run[:i % 3], run[i % 3 + 1:]))
        place = [i // 3 for i in place]
        level = [digest("".join(level[i:i + 3])) for i in range(0, len(level), 3)]
    return level[0], paths


def plain_manifest(rows):
    of_source, subroots, out = defaultdict(list), [], []
    for r in rows:
        of_source[r["source"]].append(r)
    sources = sorted(of_source, key=lambda s: (s is not None, (s or "").encode()))
    found = []
    for s in sources:
        members = sorted(of_source[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        subroot, paths = tree([leaf(r, r["text"]) for r in members])
        subroots.append(subroot)
        found.append((members, paths))
    root, upper = tree(subroots)
    for (members, paths), subroot, above in zip(found, subroots, upper):
        for r, path in zip(members, paths):
            path, text = path + above, r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf(r, text)
            for left, right in path:
                node = digest("".join(left) + node + "".join(right))
            out.append((r["doc_id"], leaf(r, r["text"]), subroot, root, digest("".join("".join(a + b) for a, b in path)), node, node == root))
    return sorted(map(repr, out))


def manifest_rows(docs):
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted(repr(tuple(r[c] for c in columns)) for r in merkle.tampered_manifest(docs).collect())


def test_manifest_edges(spark):
    docs = edge_docs(spark)
    assert manifest_rows(docs) == plain_manifest(docs.collect())
    assert merkle.tampered_manifest(empty_docs(spark)).collect() == []


@pytest.mark.parametrize("rows, sources", [(1, 1), (3, 1), (4, 1), (1000, 1), (90, 90), (700, 40)])
def test_manifest_shapes(spark, monkeypatch, rows, sources):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 60)  # a source spans many ranges
    docs = spark.range(rows).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("line\nof "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"),
        # a third of all rows in one source
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("é" if sources > 50 else "s"), (F.col("id") % sources).cast("string"))).alias("source"),
        F.lit(9).cast("long").alias("n_chars")).orderBy(F.rand(1))
    rows_there = docs.collect()
    assert manifest_rows(spark.createDataFrame(rows_there, docs.schema)) == plain_manifest(rows_there)


def test_manifest_of_equal_rows(spark):
    docs = spark.createDataFrame([(7, "a", "s", "en", 1)] * 40 + [(None, None, None, None, None)] * 2,
                                 "doc_id long, text string, source string, lang string, n_chars long")
    assert manifest_rows(docs) == plain_manifest(docs.collect())


# --- passages --------------------------------------------------------------------------------------

def plain_passages(texts, window, reference=None):
    words = [WORDS.findall((t or "").encode()) for t in texts]
    windows = lambda rows: Counter(tuple(w[i:i + window]) for w in rows for i in range(len(w) - window + 1))
    known = windows(words if reference is None else [WORDS.findall((t or "").encode()) for t in reference])
    out = []
    for w in words:
        gone = {j for i in range(len(w) - window + 1) if known[tuple(w[i:i + window])] >= (2 if reference is None else 1) for j in range(i, i + window)}
        out.append((len(w), len(gone), hashlib.sha256(b" ".join(x for j, x in enumerate(w) if j not in gone)).hexdigest()))
    return out


def passages(frame, **more):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in automata.repeated_passages(frame, **more).collect()}


def planted():
    rng, texts = random.Random(4), []
    shared = [prose(500 + i, n) for i, n in enumerate([34, 35, 36, 60, 150])]
    for i in range(90):
        # a common line in ever different surroundings, and passages that share all but their ends
        texts.append(" ".join([prose(i, 30), shared[i % 5], prose(900 + i, rng.randint(0, 20)), shared[4][:300], "w" + prose(i, 1)]))
    texts += [prose(700, 80)] * 3 + ["la " * 120, "la " * 34, "été \u0085 " * 40, None, ""]
    return texts


@pytest.mark.parametrize("members, shard", [(200, 40_000), (3, 200)])
def test_passages(spark, monkeypatch, members, shard):
    monkeypatch.setattr(automata, "MEMBERS", members)
    monkeypatch.setattr(automata, "SHARD_WORDS", shard)
    monkeypatch.setattr(automata, "SEGMENT", 50)
    texts = planted()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = passages(docs)
    assert [got[i] for i in range(len(texts))] == plain_passages(texts, 35)
    assert got[90][1] == 80 and got[93][1] == 120 and got[94][1] == 0


def test_passages_of_a_reference(spark, monkeypatch):
    monkeypatch.setattr(automata, "SHARD_WORDS", 100)  # the stream of a shard comes in several pieces
    texts, reference = planted(), [prose(503, 60), prose(700, 80), prose(504, 150) + " more", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known = spark.createDataFrame(list(enumerate(reference)), "doc_id long, text string")
    got = passages(docs, reference=known, window=30)
    assert [got[i] for i in range(len(texts))] == plain_passages(texts, 30, reference)


def test_passage_edges(spark):
    docs = edge_docs(spark)
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in automata.repeated_passages(docs).collect())
    texts = [r[1] for r in EDGE_ROWS]
    assert got == Counter((r[0], *found) for r, found in zip(EDGE_ROWS, plain_passages(texts, 35)))
    assert (2, 0, 0, EMPTY) in got and got[(6, 300, 300, EMPTY)] == 2
    assert automata.repeated_passages(empty_docs(spark)).collect() == []


def test_without_passages(spark):
    docs = edge_docs(spark)
    left = automata.without_passages(docs)
    assert left.columns == docs.columns and left.count() == len(EDGE_ROWS)
    got = {r["doc_id"]: r["text"] for r in left.collect()}
    assert (got[8], got[7], got[2], got[1], got[5]) == ("tail", "", None, "", LONG)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=12), min_size=1, max_size=5), st.integers(1, 4), st.integers(1, 3))
def test_suffix_automaton(sequences, window, least):
    automaton, places = automata.SuffixAutomaton(), Counter()
    for weight, s in enumerate(sequences, 1):
        automaton.add(s, weight)
        for i in range(len(s)):
            for j in range(i + 1, len(s) + 1):
                places[tuple(s[i:j])] += weight
    matcher = automaton.frequent(least, window)
    if matcher is None:
        assert all(n < least for s, n in places.items() if len(s) >= window)
        return
    for s in sequences:
        covered = {j for i in range(len(s) - window + 1) if places[tuple(s[i:i + window])] >= least for j in range(i, i + window)}
        assert {j for a, b in matcher.spans(s, window) for j in range(a, b)} == covered
