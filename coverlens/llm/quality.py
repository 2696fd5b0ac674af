"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

The features approximate a Gaussian kernel over standardised statistics of the whole text.  Every
partition adds up its part of the normal equations, by fold, so one pass over the labelled
rows gives the model and the out-of-fold models that the calibration needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlens.llm.common import prefix_hashes, substring_hashes, written

FEATURES = 200      # random Fourier features
RIDGE = 1e-4        # of the training rows' number
FOLDS = 4
BINS = 1000         # ridge scores are counted per bin for the calibration
STRETCH = 48        # words of one stretch; the worst stretch of a text counts too
CHUNK_BYTES = 700_000
SCORE_RANGE = (-0.5, 1.5)

STATISTICS = [
    "log_words", "log_bytes", "word_length", "word_spread", "upper", "digits", "symbols", "wide", "lines",
    "repeats", "distinct", "capitals", "odd_words", "stops", "commas",
    "worst_repeats", "worst_distinct", "worst_capitals", "worst_odd", "worst_stops", "best_distinct", "worst_length"]

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_UPPER, _DIGIT, _SYMBOL = (np.zeros(256, np.int32) for _ in range(3))
_UPPER[65:91] = 1
_DIGIT[48:58] = 1
_SYMBOL[[ord(c) for c in "!\"#$%&*+/<=>@[\\]^_`{|}~"]] = 1


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of STATISTICS per whole text (UTF-8).  A text without words has zeros."""
    out = np.zeros((len(texts), len(STATISTICS)))
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    ends_of = np.cumsum([len(t) + 1 for t in texts])
    edge = np.diff(np.concatenate([[True], _SPACE[data]]).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(starts) == 0:
        return out
    running = lambda mask: np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    per_word = lambda table: (lambda c: c[ends] - c[starts])(running(table[data]))
    upper, digit, symbol = map(per_word, (_UPPER, _DIGIT, _SYMBOL))
    wide = (lambda c: c[ends] - c[starts])(running(data >= 128))
    length = ends - starts
    text_of = np.searchsorted(ends_of, starts, side="right")
    first = np.flatnonzero(np.concatenate([[True], text_of[1:] != text_of[:-1]]))
    rows, count = text_of[first], np.diff(np.concatenate([first, [len(starts)]]))
    hashes = substring_hashes(prefix_hashes(data), starts, ends)
    # stretches of STRETCH words; what is left at a text's end forms one more
    inside = np.arange(len(starts)) - np.repeat(first, count)
    stretch_first = np.flatnonzero(inside % STRETCH == 0)
    stretch_count = np.diff(np.concatenate([stretch_first, [len(starts)]]))
    stretch = np.repeat(np.arange(len(stretch_first)), stretch_count)

    def shares(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mean over the text, highest and lowest mean over stretches of at least half the usual length."""
        means = np.add.reduceat(values, stretch_first) / stretch_count
        small = (stretch_count < STRETCH // 2) & (inside[stretch_first] > 0)
        at = np.flatnonzero(inside[stretch_first] == 0)
        return (np.add.reduceat(values, first) / count,
                np.maximum.reduceat(np.where(small, -np.inf, means), at),
                np.minimum.reduceat(np.where(small, np.inf, means), at))

    order = np.lexsort((hashes, stretch))
    new = np.ones(len(starts))
    same = (stretch[order][1:] == stretch[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    new[order[1:][same]] = 0.0
    again = np.concatenate([[0.0], (hashes[1:] == hashes[:-1]) & (text_of[1:] == text_of[:-1])])
    stop = (data[ends - 1] == ord(".")).astype(float)
    comma = (data[ends - 1] == ord(",")).astype(float)
    letters = np.maximum(length - digit - symbol, 1)
    repeats, distinct = shares(again), shares(new)
    capitals = shares(((upper >= 2) & (upper >= 0.6 * letters)).astype(float))
    odd = shares(((symbol > 0) | (digit > 0)).astype(float))
    stops, lengths = shares(stop), shares(length.astype(float))
    square = np.add.reduceat(length.astype(float) ** 2, first) / count
    n_bytes = np.maximum(np.add.reduceat(length, first), 1)
    total = lambda values: np.add.reduceat(values, first) / n_bytes
    lines = np.bincount(np.searchsorted(ends_of, np.flatnonzero(data == 10), side="right"), minlength=len(texts))[rows]
    out[rows] = np.column_stack([
        np.log1p(count), np.log1p(n_bytes), lengths[0], np.sqrt(np.maximum(square - lengths[0] ** 2, 0)),
        total(upper), total(digit), total(symbol), total(wide), lines / count,
        repeats[0], distinct[0], capitals[0], odd[0], stops[0], shares(comma)[0],
        repeats[1], distinct[2], capitals[1], odd[1], stops[2], distinct[1], lengths[1]])
    return out


def _read_texts(column: pa.Array) -> Iterator[list[bytes]]:
    texts, size = [], 0
    for value in column:
        texts.append((value.as_py() or "").encode())
        size += len(texts[-1])
        if size >= CHUNK_BYTES:
            yield texts
            texts, size = [], 0
    yield texts


def _statistics_of(column: pa.Array) -> np.ndarray:
    return np.concatenate([statistics(texts) for texts in _read_texts(column) if texts] or [np.zeros((0, len(STATISTICS)))])


def _lists(matrix: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32), matrix.ravel())


def statistics_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, stats) of every row, written: the texts are read once."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), _lists(_statistics_of(batch.column("text")))], ["key", "stats"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return written(rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, stats array<double>"), "statistics")


@dataclass
class Model:
    """``weights`` has one column for all folds together and one without each fold."""

    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray    # calibration: ridge scores ...
    values: np.ndarray   # ... and the share of label 1 there, never falling

    def features(self, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.mean) / self.spread, -5, 5)
        waves = np.cos(scaled @ self.directions + self.phases) * np.sqrt(2 / FEATURES)
        return np.column_stack([waves, np.ones(len(stats))])

    def scores(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated scores; a small share of the ridge score keeps the order within flat parts."""
        ridge = np.clip(self.features(stats) @ self.weights[:, 0], *SCORE_RANGE)
        level = (ridge - SCORE_RANGE[0]) / (SCORE_RANGE[1] - SCORE_RANGE[0])
        return np.clip(0.99 * np.interp(ridge, self.knots, self.values) + 0.01 * level, 0.0, 1.0)


def isotonic(positions: np.ndarray, positives: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares never-falling fit to shares (positives / counts): mean position and share of each pooled block."""
    blocks: list[list[float]] = []
    for x, p, n in zip(positions, positives, counts):
        blocks.append([x * n, p, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            top = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], top)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(stats: DataFrame, labels: DataFrame, key: str, label: str, seed: int = 1) -> Model:
    """Train on all rows of ``stats`` that have a label in ``labels`` (0 or 1; others are left out)."""
    known = labels.filter(F.col(label).isin(0, 1)).select(F.col(key).alias("key"), F.col(label).cast("double").alias("label"))
    rows = written(stats.join(known, "key").withColumn(
        "fold", F.pmod(F.xxhash64("key"), F.lit(FOLDS)).cast("int")), "labelled")
    size = len(STATISTICS)
    moments = rows.agg(F.count("*").alias("n"), *[f(F.col("stats")[i]) for i in range(size) for f in (F.avg, F.stddev_pop)]).first()
    random, n = np.random.default_rng(seed), moments[0]
    model = Model(np.array([moments[1 + 2 * i] or 0.0 for i in range(size)]),
                  np.array([moments[2 + 2 * i] or 0.0 for i in range(size)]) + 1e-9,
                  random.normal(size=(size, FEATURES)) * 0.2, random.uniform(0, 2 * np.pi, FEATURES),
                  np.zeros((FEATURES + 1, FOLDS + 1)), np.array([0.0]), np.array([0.5]))
    if n == 0:
        return model

    # a partition's sums: the lower half of Z'Z and Z'y, one fold after the other
    width = FEATURES + 2
    lower = np.tril_indices(width)

    def sums(batches):
        total = np.zeros((FOLDS, width, width))
        for batch in batches:
            stats_, label_, fold_ = (batch.column(c) for c in ("stats", "label", "fold"))
            z = model.features(np.asarray(stats_.flatten()).reshape(-1, size))
            z, fold_ = np.column_stack([z, np.asarray(label_)]), np.asarray(fold_)
            for f in range(FOLDS):
                total[f] += z[fold_ == f].T @ z[fold_ == f]
        cells = total[:, lower[0], lower[1]].ravel()
        used = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(cells[used])], ["cell", "value"])

    cells = (rows.select("stats", "label", "fold").mapInArrow(sums, "cell long, value double")
             .groupBy("cell").agg(F.sum("value").alias("value")).toPandas())
    flat = np.zeros(FOLDS * len(lower[0]))
    flat[cells["cell"].to_numpy()] = cells["value"].to_numpy()
    folds = np.zeros((FOLDS, width, width))
    folds[:, lower[0], lower[1]] = flat.reshape(FOLDS, -1)
    folds = folds + np.transpose(np.tril(folds, -1), (0, 2, 1))
    every = folds.sum(axis=0)
    for column, part in enumerate([every, *(every - f for f in folds)]):
        ridge = RIDGE * max(part[FEATURES, FEATURES], 1.0) * np.eye(FEATURES + 1)
        model.weights[:, column] = np.linalg.solve(part[:-1, :-1] + ridge, part[:-1, -1])

    def binned(batches):
        for batch in batches:
            z = model.features(np.asarray(batch.column("stats").flatten()).reshape(-1, size))
            fold_ = np.asarray(batch.column("fold"))
            own = np.clip((z * model.weights[:, 1 + fold_].T).sum(axis=1), *SCORE_RANGE)
            bins = ((own - SCORE_RANGE[0]) / (SCORE_RANGE[1] - SCORE_RANGE[0]) * (BINS - 1)).round().astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("label")], ["bin", "label"])

    bins = (rows.select("stats", "label", "fold").mapInArrow(binned, "bin long, label double")
            .groupBy("bin").agg(F.sum("label").alias("positives"), F.count("*").alias("n")).orderBy("bin").toPandas())
    at = SCORE_RANGE[0] + bins["bin"].to_numpy() / (BINS - 1) * (SCORE_RANGE[1] - SCORE_RANGE[0])
    model.knots, model.values = isotonic(at, bins["positives"].to_numpy(), bins["n"].to_numpy())
    return model


def training_labels(labels: DataFrame, key: str, folds: int, held: int) -> DataFrame:
    """Labels of keys whose crc32 (as text) modulo ``folds`` is not ``held``."""
    return labels.filter(~held_out(F.col(key), folds, held))


def held_out(key: Column, folds: int, held: int) -> Column:
    """A null key is not held out; it has no label either."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == held, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                  label: str = "quality", held: int = 1) -> DataFrame:
    """One row per input row: ``key``, held_out, score (0 to 1, higher: label 1 likelier), predicted (score >= 0.5).

    Only the whole text is an input of the score.  Labels of held-out keys (crc32 modulo 3 is
    ``held``) are not learned from.  Null and empty texts get the score of a text without words.
    Without any labelled row all scores lie near 0.5.  A repeated key repeats its label.  An empty table has no rows.
    Other columns play no part.
    """
    stats = statistics_table(docs, key, text)
    model = fit(stats, training_labels(labels, key, 3, held), key, label)

    def run(batches):
        for batch in batches:
            scores = model.scores(np.asarray(batch.column("stats").flatten()).reshape(-1, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                ["key", "score", "predicted"])

    kind = dict(stats.dtypes)["key"]
    scored = stats.mapInArrow(run, f"key {kind}, score double, predicted int")
    return scored.select(F.col("key").alias(key), held_out(F.col("key"), 3, held).alias("held_out"), "score", "predicted")


def score_column(model: Model, text: Column) -> Column:
    """The score of a text column, for filters that must not move the texts."""
    def run(texts):
        import pandas as pd

        return pd.Series(model.scores(_statistics_of(pa.array(texts, pa.string()))))

    return F.pandas_udf(run, "double")(text)
