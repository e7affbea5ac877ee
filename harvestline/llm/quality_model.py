"""Quality classifier: Naive-Bayes support vectors.

A text becomes the set (indicators, not counts) of its hashed n-grams:
words and word pairs, and runs of one to three word shapes (case, digits,
symbols, length, equal to a neighbour) that also say how much of the text
they cover.  Each indicator is scaled by the log-count ratio of the two
classes, rows are brought to unit length, and a linear hinge-loss model is
fitted by dual coordinate descent.  A sigmoid fitted on rows that the model
has not seen turns margins into scores from 0 to 1.

Fitting uses at most ``max_rows`` labelled rows (those with the smallest
hash of their id, whole texts) in one task: the bound, not the corpus, sets
its memory.  Scoring streams over all rows with two bounded weight vectors.

Defined results: null and empty texts have no n-gram and get the score of
the intercept; very long texts are scored whole; null ids are not trained on;
ids labelled twice count by their mean label, ties as 0, and every row that
repeats a chosen id is trained on; rows of equal hash are chosen by id; without
rows of both classes every score is the share of label 1 among training rows,
0.5 without any; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, row_groups, text_buffers
from .kernels import SEGMENT, span_hashes, window_hashes, word_spans

BITS = 20
MAX_ROWS = 12_000
THRESHOLD = 0.7
_U = np.uint64
_WEIGHED = np.dtype([("feature", np.int32), ("weight", np.float32)])

# byte classes: 0 other (letters beyond ASCII too), 1 lower, 2 upper, 3 digit, 4 symbol, 5 sentence mark
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
_CLASS[[ord(c) for c in "#*$%&|<>@^~=_\\/{}[]+!"]] = 4
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 5


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A small number for the look of each word."""
    cls = _CLASS[data]
    length = ends - starts

    def how_many(c):
        total = np.concatenate(([0], np.cumsum(cls == c)))
        return total[ends] - total[starts]

    upper, digit, symbol = how_many(2), how_many(3), how_many(4)
    case = np.where(upper == 0, 0, np.where(upper * 2 >= np.maximum(length - symbol, 2), 2, 1))
    size = np.digitize(length, (2, 4, 8, 16, 40))
    same = np.zeros(len(words), np.int64)
    for back in (1, 2, 3):
        if len(words) > back:
            equal = (words[back:] == words[:-back]) & (rows[back:] == rows[:-back])
            same[back:][equal & (same[back:] == 0)] = back
    return ((((case * 2 + (digit > 0)) * 3 + np.minimum(symbol, 2)) * 6 + size) * 4 + same) * 6 + cls[ends - 1]


def text_features(column: pa.Array, bits: int = BITS) -> Iterator[np.ndarray]:
    """The sorted distinct feature numbers of each text."""
    data, off = text_buffers(column)
    shift = _U(64 - bits)
    for a, b in row_groups(off, SEGMENT):
        part, po = data[off[a]:off[b]], off[a:b + 1] - off[a]
        starts, ends, rows = word_spans(part, po)
        words = span_hashes(part, starts, ends, fold_case=True)
        shapes = _shapes(part, starts, ends, span_hashes(part, starts, ends), rows)
        looks = window_hashes(shapes.astype(_U) + _U(11), 1)
        pairs, two, three = window_hashes(words, 2), window_hashes(looks, 2), window_hashes(looks, 3)
        bounds = np.searchsorted(rows, np.arange(len(po)))
        for i in range(len(po) - 1):
            s, e = bounds[i], bounds[i + 1]
            if s == e:
                yield np.zeros(0, np.int32)
                continue
            found = [words[s:e], pairs[s:max(s, e - 1)]]
            for k, grams in ((1, looks[s:e]), (2, two[s:max(s, e - 1)]), (3, three[s:max(s, e - 2)])):
                g, c = np.unique(grams, return_counts=True)
                share = np.digitize(c / (e - s), (0.02, 0.1, 0.25, 0.5))
                for level in range(5):  # an indicator for each share that is reached
                    found.append((g[share >= level] ^ _U(0x9E37 * (level + 1))) * _U(0xD6E8FEB86659FD93))
            yield np.unique(np.concatenate(found) >> shift).astype(np.int32)


@dataclass
class Model:
    """The features that weigh anything with their scaled weights and squared
    scales, intercept, sigmoid.  Only these features travel; a worker spreads
    them over all numbers once."""

    features: np.ndarray
    weight: np.ndarray
    square: np.ndarray
    intercept: float
    slope: float
    shift: float
    bits: int

    @classmethod
    def of(cls, weight: np.ndarray, square: np.ndarray, intercept: float, slope: float, shift: float, bits: int) -> Model:
        features = np.flatnonzero((weight != 0) | (square != 0)).astype(np.int32)
        return cls(features, weight[features], square[features], intercept, slope, shift, bits)

    @cached_property
    def spread(self) -> tuple[np.ndarray, np.ndarray]:
        weight, square = np.zeros(1 << self.bits, np.float32), np.zeros(1 << self.bits, np.float32)
        weight[self.features], square[self.features] = self.weight, self.square
        return weight, square

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "spread"}

    def margin(self, features: np.ndarray) -> float:
        if not len(features):
            return self.intercept
        weight, square = self.spread
        norm = float(square[features].sum(dtype=np.float64))
        return self.intercept + (float(weight[features].sum(dtype=np.float64)) / norm ** 0.5 if norm else 0.0)

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(features) + self.shift, -30, 30))))


def descend(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: float, epochs: int,
            seed: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the linear hinge-loss model over rows of
    indicators times ``scale``, brought to unit length: every dual variable stays
    between 0 and ``cost``.  Returns weights of the scaled indicators and the
    intercept, which is one more coordinate."""
    w, bias, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(rows))
    norm = [max(float(np.sqrt((scale[r] ** 2).sum())), 1e-12) for r in rows]
    diagonal = np.array([2.0 if n > 1e-12 else 1.0 for n in norm])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        largest = 0.0
        for i in rng.permutation(len(rows)):
            r = rows[i]
            value = scale[r] / norm[i]
            gradient = y[i] * (float(w[r] @ value) + bias) - 1
            step = min(max(alpha[i] - gradient / diagonal[i], 0.0), cost) - alpha[i]
            if step:
                alpha[i] += step
                w[r] += step * y[i] * value
                bias += step * y[i]
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return w, bias


def _counts(rows: list[np.ndarray], size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for r in rows:
        out[r] += 1  # a row's features are distinct
    return out


def fit(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, cost: float = 1.0, epochs: int = 12,
        smoothing: float = 1.0, least_rows: int = 3, seed: int = 7) -> Model:
    size, y = 1 << bits, np.where(labels > 0, 1.0, -1.0)
    share = float((y > 0).mean()) if len(y) else 0.5
    flat = Model(np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(0, np.float32), 0.0, 0.0,
                 float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))), bits)
    if len(y) < 10 or share in (0.0, 1.0):
        return flat
    fold = np.random.default_rng(seed).permutation(len(rows)) % 5 == 0
    if len({*y[fold]}) < 2 or len({*y[~fold]}) < 2:
        fold = np.zeros(len(rows), bool)

    def one(use: np.ndarray) -> Model:
        good = _counts([r for r, l, u in zip(rows, y, use) if u and l > 0], size)
        bad = _counts([r for r, l, u in zip(rows, y, use) if u and l < 0], size)
        ratio = np.log((good + smoothing) / (good.sum() + smoothing)) - np.log((bad + smoothing) / (bad.sum() + smoothing))
        # what few rows have says little
        ratio[good + bad < least_rows] = 0
        w, bias = descend([r for r, u in zip(rows, use) if u], ratio, y[use], cost, epochs, seed)
        return Model.of((w * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), bias, 1.0, 0.0, bits)

    trial = one(~fold)
    held = fold if fold.any() else ~fold
    m, t = np.array([trial.margin(r) for r, u in zip(rows, held) if u]), (y[held] > 0).astype(float)
    t = np.where(t > 0, (t.sum() + 1) / (t.sum() + 2), 1 / ((1 - t).sum() + 2))  # Platt's smoothed targets
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of a ridge-stabilised logistic fit
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        g = np.array([((p - t) * m).sum() + 1e-3 * a, (p - t).sum()])
        v = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(v * m * m).sum() + 1e-3, (v * m).sum()], [(v * m).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        size_of = float(np.abs(step).max())
        step *= min(1.0, 2.0 / max(size_of, 1e-12))
        a, b = a - step[0], b - step[1]
        if size_of < 1e-8:
            break
    final = one(np.ones(len(rows), bool))
    final.slope, final.shift = float(max(a, 1e-6)), float(b)
    return final


def _fit_task(bits: int):
    def run(batches: Iterator[pa.RecordBatch]):
        got, blocks = [], []
        for batch in batches:
            found = list(text_features(batch.column("text"), bits))
            for k, (i, y) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("label").to_pylist())):
                got.append((i, y, len(found[k]), len(blocks), k))
            blocks.append((np.concatenate(found), np.cumsum([0, *map(len, found)])))  # one array, not one a row
        got.sort()
        rows = [blocks[b][0][blocks[b][1][k]:blocks[b][1][k + 1]] for _, _, _, b, k in got]
        model = fit(rows, np.array([x[1] for x in got], float), bits)
        weighed = np.zeros(len(model.features), _WEIGHED)
        weighed["feature"], weighed["weight"] = model.features, model.weight
        yield pa.RecordBatch.from_arrays(
            [pa.array([weighed.tobytes()]), pa.array([model.square.tobytes()]),
             *(pa.array([x]) for x in (model.intercept, model.slope, model.shift))],
            ["weight", "square", "intercept", "slope", "shift"])
    return run


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, bits: int = BITS) -> Model:
    """Fit on up to ``max_rows`` rows of ``docs`` (doc_id, text) that ``labels``
    (doc_id, label 0/1) marks.  What comes back is 12 bytes a feature that weighs anything."""
    prepare(docs.sparkSession)
    marked = (labels.where("doc_id is not null and label is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
                    .agg((F.avg("label") > 0.5).cast("int").alias("label")))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = (docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")  # max_rows rows
                .repartition(1).mapInArrow(_fit_task(bits), "weight binary, square binary, intercept double, slope double, shift double"))
    r = rows.first()
    if r is None:
        return fit([], np.zeros(0), bits)
    weighed = np.frombuffer(r.weight, _WEIGHED)
    return Model(weighed["feature"].copy(), weighed["weight"].copy(), np.frombuffer(r.square, np.float32), r.intercept, r.slope, r.shift, bits)


def score_column(spark: SparkSession, model: Model, text: Column) -> Column:
    """The score of ``text`` as a Column (Arrow batches, whole texts)."""
    prepare(spark)
    ref = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        model = ref.value
        return pa.array([model.score(f) for f in text_features(texts, model.bits)], pa.float64())

    return score(text)
