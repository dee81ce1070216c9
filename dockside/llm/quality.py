"""Quality classifier: naive Bayes support vectors over hashed n-gram indicators.

A text's features are the distinct n-grams it has: byte n-grams, and n-grams of word shapes, where a shape tells case,
symbols, digits, length and whether the word repeats an earlier one.  Each indicator is scaled by its class log-count
ratio, a linear hinge-loss model is fitted by dual coordinate descent, and its margin is calibrated to a probability
on labelled rows that it was not fitted on.

The model is one weight for each of 2^18 buckets, whatever the size of the corpus.  Scoring is one pass without a
shuffle.  Whole texts are read; very long ones in blocks.

Edge cases: null text is empty; an empty text has the single n-gram "no words" and gets a score like any other.  Words of
any length are counted whole.  Repeated rows get the same score each.  With
no labelled rows, or one class only, every score is the smoothed share of label 1.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dockside.llm.labelled import held_out, training_rows

BUCKET_BITS = 18
FOLDS, FOLD = 5, 0
THRESHOLD = 0.3
#: Bound of the labelled rows that the model is fitted and calibrated on.
MAX_TRAIN_ROWS = 6_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
#: Class of each byte: 0 other, 1 lower case and non-ASCII, 2 upper case, 3 digit, 4 symbol.
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123] = _CLASS[128:] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[ord(c) for c in "#*$%&|<>{}[]\\^~=_@/"]] = 4
#: Bits of a class in a packed count.
_BITS = 12
#: One in the bits of the byte's class, nothing for white space.
_COUNT = np.where(_WORD, np.left_shift(np.uint64(1), np.uint64(_BITS) * _CLASS.astype(np.uint64)), np.uint64(0))
BLOCK = 1 << 20


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    return ((h + np.uint64(kind)) * _MIX >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _byte_grams(b: np.ndarray, seen: np.ndarray) -> None:
    """Marks the buckets of all byte n-grams, n from 1 to 4."""
    for at in range(0, len(b), BLOCK):
        h = part = b[at:at + BLOCK + 3].astype(np.uint64)
        for n in range(1, 5):
            seen[_bucket(h, n << 56)] = True
            h = h[:-1] * np.uint64(257) + part[n:] + np.uint64(1)


def _shares(share: float) -> int:
    return int(np.searchsorted([0.002, 0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.5, 0.8], share))


def _class_counts(b: np.ndarray, starts: np.ndarray, longest: int) -> list[np.ndarray]:
    """For each class, how many bytes of it every word has; packed in one sum where the longest word fits its bits."""
    if longest < 1 << _BITS:
        counts = np.add.reduceat(_COUNT[b], starts)
        return [(counts >> np.uint64(_BITS * c)) & np.uint64((1 << _BITS) - 1) for c in range(5)]
    kind = np.where(_WORD[b], _CLASS[b], 5)
    return [np.add.reduceat(kind == c, starts, dtype=np.int64) for c in range(5)]


def _word_grams(raw: bytes, b: np.ndarray, seen: np.ndarray) -> None:
    """Marks n-grams of word shapes, n from 1 to 3, and the steps that the shares of some shapes reach."""
    words = raw.split()  # at the six bytes that are no _WORD
    n = len(words)
    if not n:
        seen[_bucket(np.array([1], np.uint64), 9 << 56)] = True
        return
    word = _WORD[b]
    starts = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    if word[0]:
        starts = np.append(0, starts)
    lengths = np.fromiter(map(len, words), np.int64, n)
    names = np.fromiter(map(hash, words), np.int64, n)  # compared within the text only
    count = _class_counts(b, starts, int(lengths.max()))
    upper = (count[2] > 1) & (count[2] >= count[1])
    same = np.concatenate(([False], names[1:] == names[:-1]))
    same2 = np.concatenate(([False] * min(2, n), names[2:] == names[:-2]))
    symbol, digit, other = count[4] > 0, count[3] > 0, count[0] > 1
    shape = (
        upper + 2 * same + 4 * same2 + 8 * symbol + 16 * digit + 32 * other + 64 * np.digitize(lengths, [2, 4, 8, 16, 32])
    ).astype(np.uint64)
    h = shape
    for k in range(1, 4):
        seen[_bucket(h, (9 + k) << 56)] = True
        h = h[:-1] * np.uint64(1021) + shape[k:] + np.uint64(1)
    distinct, times = np.unique(names, return_counts=True)
    lines = np.count_nonzero(b == 10) + 1
    shares = [x.mean() for x in (upper, same, same2, symbol, digit, other)]
    shares += [1 - len(distinct) / n, times.max() / n, min(1.0, lines / n)]
    steps = [_shares(float(x)) for x in shares] + [int(np.log2(n + 1) * 2), int(lengths.mean())]
    steps = [(k << 8) + x for k, s in enumerate(steps) for x in ([s] if k >= len(shares) else range(s + 1))]
    seen[_bucket(np.array(steps, np.uint64), 14 << 56)] = True


def features(text: str, seen: np.ndarray) -> np.ndarray:
    """Ascending buckets of the n-grams that the text has; ``seen`` is all false, and is so again afterwards."""
    raw = text.encode("utf-8", "replace")
    b = np.frombuffer(raw, np.uint8)
    _byte_grams(b, seen)
    _word_grams(raw, b, seen)
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


@dataclass(frozen=True)
class QualityModel:
    """Score of a text: 1 / (1 + exp(-(slope * (weights of its n-grams / sqrt(their number) + bias) + offset)))."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, found: np.ndarray) -> float:
        margin = self.weights[found].sum(dtype=np.float64) / np.sqrt(len(found)) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    counts = np.zeros((2, 1 << BUCKET_BITS))
    for found, label in zip(rows, y):
        counts[int(label > 0), found] += 1
    p = (counts[1] + alpha) / (counts[1] + alpha).sum()
    q = (counts[0] + alpha) / (counts[0] + alpha).sum()
    return np.log(p / q)


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray, epochs: int, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Weights and bias of min |w|^2 / 2 + sum of cost * max(0, 1 - y (w x + b)), one dual variable at a time."""
    w, bias, alpha = np.zeros(1 << BUCKET_BITS), 0.0, np.zeros(len(rows))
    square = np.array([v @ v + 1 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gradient = y[i] * (w[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            if (step := (new - alpha[i]) * y[i]) != 0:
                w[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(step) / cost[i])
                alpha[i] = new
        if moved < 1e-3:
            break
    return w, bias


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through (margin, label), by Newton's method with smoothed targets."""
    positive, negative = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    a, b = 1.0, 0.0
    x = np.stack([margin, np.ones_like(margin)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = x @ (p - target) + np.array([1e-3 * a, 0])
        h = (x * (p * (1 - p) + 1e-9)) @ x.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2 / (np.abs(step).max() + 1e-12))
        a, b = a - step[0], b - step[1]
    return float(a), float(b)


def fit(rows: list[np.ndarray], y: np.ndarray, *, c: float = 1.0, epochs: int = 30, calibrate: float = 0.25) -> QualityModel:
    """Fits on the first part of the rows, in the order given, and calibrates on the rest."""
    y = np.where(np.asarray(y) > 0, 1.0, -1.0)
    if not len(y) or abs(y.sum()) == len(y):
        share = ((y > 0).sum() + 1) / (len(y) + 2)
        return QualityModel(np.zeros(1 << BUCKET_BITS, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))
    cut = len(y) - int(len(y) * calibrate)
    if len(set(y[:cut])) < 2 or len(set(y[cut:])) < 2:
        cut = len(y)
    ratio = log_count_ratios(rows[:cut], y[:cut])
    values = [(ratio[r] / np.sqrt(len(r))).astype(np.float32) for r in rows[:cut]]  # half the memory
    share = (y[:cut] > 0).mean()
    cost = c * np.where(y[:cut] > 0, 0.5 / share, 0.5 / (1 - share))
    w, bias = dual_coordinate_descent(rows[:cut], values, y[:cut], cost, epochs)
    weights = (w * ratio).astype(np.float32)
    rest = slice(cut, None) if cut < len(y) else slice(None)
    margin = np.array([weights[r].sum(dtype=np.float64) / np.sqrt(len(r)) + bias for r in rows[rest]])
    return QualityModel(weights, bias, *_platt(margin, y[rest]))


def train(
    docs: DataFrame, labels: DataFrame, *, label: str = "quality", folds: int = FOLDS, fold: int = FOLD,
    max_rows: int = MAX_TRAIN_ROWS,
) -> QualityModel:
    """The model of the labelled rows outside the held-out fold, at most ``max_rows`` of them."""

    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(1 << BUCKET_BITS, bool)
        for frame in frames:
            rows = [features(t, seen).astype("<i4").tobytes() for t in frame["text"]]
            yield pd.DataFrame({"order": frame["order"], "label": frame["label"], "grams": rows})

    known = training_rows(docs, labels, label, folds=folds, fold=fold, max_rows=max_rows)
    known = known.select("text", "label", F.xxhash64("doc_id", "text").alias("order"))
    rows = known.mapInPandas(found, "order long, label double, grams binary").collect()
    rows.sort(key=lambda r: (r["order"], r["label"]))
    return fit([np.frombuffer(r["grams"], "<i4") for r in rows], np.array([r["label"] for r in rows]))


def score(spark: SparkSession, model: QualityModel, text: str | Column = "text") -> Column:
    """Probability of label 1 as a column; the model is broadcast, a megabyte whatever the corpus."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        seen = np.zeros(1 << BUCKET_BITS, bool)
        for batch in batches:
            yield pd.Series([shared.value.score(features(t, seen)) for t in batch], dtype="float64")

    return scores(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def classify(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, **fitting) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(docs, labels, **fitting)
    folds, fold = fitting.get("folds", FOLDS), fitting.get("fold", FOLD)
    scored = docs.select("doc_id", score(docs.sparkSession, model).alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, **fitting) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    model = train(docs, labels, **fitting)
    return docs.where(score(docs.sparkSession, model) >= threshold)
