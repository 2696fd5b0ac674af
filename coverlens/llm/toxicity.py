"""Toxicity: a bidirectional recurrent network with attention pooling over character and word inputs.

A text is cut into overlapping windows of words; all of them are scored and the worst one
counts.  A word is given to the network as learned vectors of itself and of its character
n-grams, and by how much more often both stand in toxic than in other training texts.
The network is trained in numpy on a bounded sample of labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens.llm.common import hash_order, prefix_hashes, small_batches, substring_hashes
from coverlens.llm.quality import held_out, training_labels
from coverlens.llm.recurrent import Adam, Network, sigmoid, sums_by

SAMPLE = (1_500, 2_000)   # toxic and other labelled texts to train on, at most (in hash order of their ids)
LONGEST = 200_000         # bytes of a text to train on, at most; longer ones are scored only
WINDOW, STRIDE = 64, 48   # words; windows overlap by the difference
HIDDEN, EMBED = 8, 6
GRAMS = (4, 5, 6, 7)      # bytes of a character n-gram, with the word's ends as blanks
COUNT_ROWS, EMBED_ROWS = 1 << 18, 1 << 15   # hash ranges of the counts and of the learned vectors
EPOCHS, BATCH = 6, 256
LEAST_STEPS = 200         # small samples are gone through more often
TABLE_RATE, TABLE_DECAY = 0.005, 0.002
FOLDS = 4
CHUNK_BYTES = 1_000_000

# Bytes of words: digits, letters (A-Z as a-z) and all beyond ASCII; everything else separates.
_WORD = np.full(256, 32, np.uint8)
for _part in (range(48, 58), range(97, 123), range(128, 256)):
    _WORD[list(_part)] = list(_part)
_WORD[65:91] = np.arange(97, 123)


class Words:
    """The words of some texts: ``ids`` numbers of distinct words in reading order, ``text_of`` each one's text."""

    def __init__(self, texts: list[bytes]):
        data = _WORD[np.frombuffer(b" " + b" ".join(texts) + b"  ", dtype=np.uint8)]
        ends_of = np.cumsum([len(t) + 1 for t in texts]) + 1
        edge = np.diff((data != 32).view(np.int8))
        starts, ends = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
        prefix = prefix_hashes(data)
        hashes, first, self.ids = np.unique(substring_hashes(prefix, starts, ends), return_index=True, return_inverse=True)
        self.text_of = np.searchsorted(ends_of, starts, side="right")
        self.hashes = hashes
        # n-grams of every distinct word, one word after the other
        begin, end = starts[first] - 1, ends[first] + 1
        counts = np.stack([np.maximum(end - begin - n + 1, int(n == GRAMS[0])) for n in GRAMS], axis=1)
        place = np.concatenate([[0], np.cumsum(counts.ravel())])
        at = np.arange(place[-1]) - np.repeat(place[:-1] - np.repeat(begin, len(GRAMS)), counts.ravel())
        size = np.repeat(np.minimum(GRAMS, (end - begin)[:, None]).ravel(), counts.ravel())  # a short word is one n-gram
        self.grams = substring_hashes(prefix, at, at + size)
        self.gram_first = place[:-1].reshape(-1, len(GRAMS))[:, 0] if len(first) else np.zeros(0, np.int64)
        self.gram_count = counts.sum(axis=1)

    @classmethod
    def of_many(cls, texts: list[bytes]) -> Words:
        """The same for many texts, read a part at a time."""
        parts, at = [], 0
        while at < len(texts) or not parts:
            n, size = 0, 0
            while at + n < len(texts) and (n == 0 or size < CHUNK_BYTES):
                size += len(texts[at + n])
                n += 1
            part = cls(texts[at:at + n])
            part.text_of += at
            parts.append(part)
            at += max(n, 1)
        out = cls.__new__(cls)
        out.hashes, first, number = np.unique(np.concatenate([p.hashes for p in parts]), return_index=True, return_inverse=True)
        offsets = np.cumsum([0] + [len(p.hashes) for p in parts])
        out.ids = np.concatenate([number[o:][p.ids] for o, p in zip(offsets, parts)])
        out.text_of = np.concatenate([p.text_of for p in parts])
        counts = np.concatenate([p.gram_count for p in parts])
        starts = np.cumsum(counts) - counts
        out.gram_count = counts[first]
        out.grams = np.concatenate([p.grams for p in parts])[_ranges(starts[first], out.gram_count)]
        out.gram_first = np.cumsum(out.gram_count) - out.gram_count
        return out

    def windows(self, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words x places, mask, text) of all overlapping windows; the last one of a text ends at its end."""
        count = np.bincount(self.text_of, minlength=n_texts)
        start_of = np.concatenate([[0], np.cumsum(count)])[:-1]
        pieces = np.where(count > 0, 1 + np.maximum(0, -(-(count - WINDOW) // STRIDE)), 0)
        text = np.repeat(np.arange(n_texts), pieces)
        number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.minimum(number * STRIDE, np.maximum(count[text] - WINDOW, 0))
        place = begin[:, None] + np.arange(WINDOW)
        mask = (place < count[text][:, None])
        ids = self.ids[np.minimum(start_of[text][:, None] + place, max(len(self.ids) - 1, 0))] if len(text) else place
        return ids, mask.astype(np.float32), text


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers start, start + 1, ... of each range, one range after the other."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def _rows(hashes: np.ndarray, size: int) -> np.ndarray:
    return (hashes % np.uint64(size)).astype(np.int64)


def _surplus(toxic: np.ndarray, other: np.ndarray, totals: tuple[float, float]) -> np.ndarray:
    """How much more often something stands in toxic texts, in half standard errors."""
    a, b = toxic + 0.5, other + 0.5
    log_odds = np.log(a / max(totals[0], 1)) - np.log(b / max(totals[1], 1))
    return (np.clip(log_odds / np.sqrt(1 / a + 1 / b), -4, 8) / 2).astype(np.float32)


class Model:
    """``surplus``: by kind and hash, how conspicuous words and n-grams are; the tables hold learned vectors."""

    def __init__(self, seed: int = 5):
        random = np.random.default_rng(seed)
        draw = lambda: random.normal(0, 0.1, (EMBED_ROWS, EMBED)).astype(np.float32)
        self.tables = {"gram": draw(), "word": draw()}
        self.surplus = {kind: np.zeros(COUNT_ROWS, np.float32) for kind in ("gram", "word")}
        self.network = Network(3 + 2 * EMBED, HIDDEN, seed, glance=[2.0, 2.0])
        self.scale = (1.0, 0.0)

    @staticmethod
    def counted(words: Words, surplus: dict[str, np.ndarray]) -> np.ndarray:
        """Of every distinct word: its own surplus, and the highest and mean one of its n-grams."""
        if len(words.hashes) == 0:
            return np.zeros((0, 3), np.float32)
        gram = surplus["gram"][_rows(words.grams, COUNT_ROWS)]
        return np.column_stack([
            surplus["word"][_rows(words.hashes, COUNT_ROWS)], np.maximum.reduceat(gram, words.gram_first),
            np.add.reduceat(gram, words.gram_first) / words.gram_count]).astype(np.float32)

    def learned(self, hashes: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if len(hashes) == 0:
            return np.zeros((0, 2 * EMBED), np.float32)
        sums = np.add.reduceat(self.tables["gram"][_rows(grams, EMBED_ROWS)], np.cumsum(counts) - counts, axis=0)
        return np.column_stack([self.tables["word"][_rows(hashes, EMBED_ROWS)], sums / counts[:, None].astype(np.float32)])

    def judge(self, inputs, windows: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """``inputs`` gives the vectors of some word numbers."""
        parts = [np.zeros(0, np.float32)]
        for at in range(0, len(windows), 4096):
            distinct, local = np.unique(windows[at:at + 4096], return_inverse=True)
            parts.append(self.network.forward(inputs(distinct), local.reshape(-1, WINDOW), mask[at:at + 4096]))
        return np.concatenate(parts)

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """The worst window's logit of each text; minus infinity without words."""
        out = np.full(len(texts), -np.inf, np.float32)
        words = Words(texts)
        windows, mask, text = words.windows(len(texts))
        inputs = np.column_stack([self.counted(words, self.surplus), self.learned(words.hashes, words.grams, words.gram_count)])
        np.maximum.at(out, text, self.judge(inputs.__getitem__, windows, mask))
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return sigmoid(self.scale[0] * np.maximum(self.logits(texts), -50).astype(np.float64) + self.scale[1])


def train(texts: list[bytes], labels: list[int], share: float, seed: int = 5) -> Model:
    """Train on whole texts; ``share`` is the part of label 1 among all labelled texts, for the calibration.

    Only texts are labelled, not windows.  Of a toxic text the window that looks worst so far is
    learned from; of any other one its worst and a random one.  A text is learned from with
    counts of other texts only.
    """
    model, random = Model(seed), np.random.default_rng(seed)
    words = Words.of_many(texts)
    windows, mask, text = words.windows(len(texts))
    y = np.array(labels, dtype=np.int64)
    present = np.unique(text)
    if len(present) == 0 or len(set(y[present].tolist())) < 2:  # nothing to tell apart
        model.network.p = {k: np.zeros_like(v) for k, v in model.network.p.items()}
        known = float(np.mean(labels)) if len(labels) else 0.0
        model.scale = (1.0, float(np.log((known + 1e-3) / (1 - known + 1e-3))))
        return model

    # in how many texts of either label each word and each n-gram stands, by fold; folds hold both
    # labels in equal parts, so that leaving one out tells nothing about the label
    fold = np.zeros(len(texts), np.int64)
    for label in (0, 1):
        own = present[y[present] == label]
        fold[random.permutation(own)] = np.arange(len(own)) % FOLDS
    counts = {kind: np.zeros((FOLDS, 2, COUNT_ROWS), np.float32) for kind in ("gram", "word")}
    in_text = np.unique(words.text_of * len(words.hashes) + words.ids)
    owner, word = in_text // len(words.hashes), in_text % len(words.hashes)
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    for t in present:
        own = word[cuts[t]:cuts[t + 1]]
        counts["word"][fold[t], 1 - y[t], np.unique(_rows(words.hashes[own], COUNT_ROWS))] += 1
        grams = words.grams[_ranges(words.gram_first[own], words.gram_count[own])]
        counts["gram"][fold[t], 1 - y[t], np.unique(_rows(grams, COUNT_ROWS))] += 1

    def surplus(without: int | None) -> dict[str, np.ndarray]:
        use = [f for f in range(FOLDS) if f != without]
        kept = present[np.isin(fold[present], use)]
        totals = (float(y[kept].sum()), float((1 - y[kept]).sum()))
        return {kind: _surplus(c[use, 0].sum(axis=0), c[use, 1].sum(axis=0), totals) for kind, c in counts.items()}

    model.surplus = surplus(None)
    # the words of each fold's texts have inputs of their own, from the counts of the other folds
    given = np.concatenate([Model.counted(words, surplus(f)) for f in range(FOLDS)])
    windows = windows + (fold[text] * len(words.hashes))[:, None]

    first = np.searchsorted(text, present)
    size = np.diff(np.concatenate([first, [len(text)]]))
    adam, squares = Adam(0.01), {kind: np.full((EMBED_ROWS, 1), 1e-4, np.float32) for kind in ("gram", "word")}

    def worst_of(value: np.ndarray) -> np.ndarray:
        """Each text's window of the highest value."""
        order = np.lexsort((-value, text))
        return order[first]

    def all_logits() -> np.ndarray:
        learned = model.learned(words.hashes, words.grams, words.gram_count)
        of = lambda rows: np.column_stack([given[rows], learned[rows % len(learned)]])
        return model.judge(of, windows, mask)

    # before anything is learned the window with the most conspicuous word is the worst
    worst = worst_of((given[:, :2].sum(axis=1)[windows] * mask).max(axis=1))
    clean = y[present] == 0
    examples = len(present) + int(clean.sum())
    batch = min(BATCH, max(16, examples // 4))
    epochs = min(60, max(EPOCHS, -(-LEAST_STEPS * batch // examples)))
    for epoch in range(epochs):
        chosen = np.concatenate([worst, (first + random.integers(0, size))[clean]])
        random.shuffle(chosen)
        for at in range(0, len(chosen), batch):
            rows = chosen[at:at + batch]
            _learn(model, words, given, windows[rows], mask[rows], y[text[rows]], adam, squares)
        if epoch % 3 == 1:
            worst = worst_of(all_logits())
    tops = all_logits()
    model.scale = _platt(tops[worst_of(tops)].astype(np.float64), y[present], share)
    return model


def _learn(model: Model, words: Words, given, windows, mask, label, adam: Adam, squares) -> None:
    """One step on some windows."""
    distinct, local = np.unique(windows, return_inverse=True)
    local, base = local.reshape(windows.shape), distinct % len(words.hashes)
    counts = words.gram_count[base]
    grams = words.grams[_ranges(words.gram_first[base], counts)]
    inputs = np.column_stack([given[distinct], model.learned(words.hashes[base], grams, counts)]).astype(np.float32)
    logits, kept = model.network.forward(inputs, local, mask, keep=True)
    # both labels weigh the same in a step
    weight = np.where(label == 1, 0.5 / max(1, label.sum()), 0.5 / max(1, len(label) - label.sum()))
    error = ((sigmoid(logits) - label) * weight).astype(np.float32)
    grads, d_inputs = model.network.backward(inputs, local, mask, kept, error)
    adam.update(model.network.p, grads)
    _table_step(model.tables["word"], squares["word"], _rows(words.hashes[base], EMBED_ROWS), d_inputs[:, 3:3 + EMBED])
    _table_step(model.tables["gram"], squares["gram"], _rows(grams, EMBED_ROWS),
                np.repeat(d_inputs[:, 3 + EMBED:] / counts[:, None], counts, axis=0))


def _table_step(table: np.ndarray, squares: np.ndarray, rows: np.ndarray, grads: np.ndarray) -> None:
    """Only touched rows learn, each at a rate by its own history, and shrink a little."""
    found, total = sums_by(rows, grads)
    squares[found] += (total ** 2).mean(axis=1, keepdims=True)
    table[found] = (1 - TABLE_DECAY) * table[found] - TABLE_RATE * total / np.sqrt(squares[found])


def _platt(logits: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and offset of a logistic fit, with both labels weighing as among all labelled texts."""
    weight = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((y == 0).sum() + 2))
    x = np.column_stack([np.clip(logits, -50, 50), np.ones(len(y))])
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ w)
        g = x.T @ (weight * (p - target)) + 1e-3 * (w - [1.0, 0.0])
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, g)
        w = w - step / max(1.0, np.abs(step).max())
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: tuple[int, int] = SAMPLE) -> Model:
    """Train on at most ``sample`` labelled texts of LONGEST bytes or less, whole ones, chosen by the hash order of their keys."""
    known = labels.filter(F.col(label).isin(0, 1)).select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    short = docs.filter(F.coalesce(F.octet_length(text), F.lit(0)) <= LONGEST).select(F.col(key).alias("key"))
    known = known.join(short, "key", "left_semi").dropDuplicates(["key"])
    count = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    order = hash_order(F.lit("toxic-sample"), F.col("key").cast("string"))
    part = lambda value, most: known.filter(F.col("label") == value).orderBy(order, "key").limit(most)
    chosen = part(1, sample[0]).unionByName(part(0, sample[1]))
    # at most sum(sample) keys: the texts are not shuffled
    rows = (docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= LONGEST).join(F.broadcast(chosen), "key").dropDuplicates(["key"]).orderBy("key").toArrow())
    texts = [(t.as_py() or "").encode() for t in rows.column("text")]
    share = count.get(1, 0) / max(1, sum(count.values()))
    return train(texts, rows.column("label").to_pylist(), share)


def score_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                   label: str = "toxic", held: int = 0, sample: tuple[int, int] = SAMPLE) -> DataFrame:
    """One row per input row: ``key``, held_out, score (0 to 1, higher: label 1 likelier), predicted (score >= 0.5).

    Every word of the whole text is in a scored window; only the text is an input.  Labels of held-out
    keys (crc32 modulo 5 is ``held``) are not learned from.  Null texts and texts without words score
    about 0.  Without labels of both kinds all texts get the same score, the share of
    label 1 (0 without any).  A repeated key counts once in training.  An empty table has no rows.
    Other columns play no part.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, training_labels(labels, key, 5, held), key, text, label, sample))
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, column, at = batch.column("key"), batch.column("text"), 0
            while at < len(column):
                texts, size = [], 0
                while at + len(texts) < len(column) and (not texts or size < CHUNK_BYTES):
                    texts.append((column[at + len(texts)].as_py() or "").encode())
                    size += len(texts[-1])
                scores = model.value.scores(texts)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(at, len(texts)), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                    ["key", "score", "predicted"])
                at += len(texts)

    scored = rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, score double, predicted int")
    return scored.select(F.col("key").alias(key), held_out(F.col("key"), 5, held).alias("held_out"), "score", "predicted")
