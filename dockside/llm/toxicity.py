"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Labelled rows outside the held-out fold are split in three by a hash of the id.  The first part yields a lexicon: words
and beginnings of words much more frequent in toxic texts.  Trees are boosted on the second, over lexicon densities,
closeness to second-person words, capitals, punctuation and obfuscation, so they see the lexicon on texts that it was
not drawn from.  The third calibrates the trees' probability by isotonic regression.

Fitting reads a bounded sample of labelled rows.  Scoring is one pass over whole texts without a shuffle; the lexicon
and the trees are what is broadcast, and the sample bounds both.

Edge cases: null text is empty; an empty text has all features zero and gets a score like any other.  Very long texts and
words are read whole, in time that grows with their length.  Repeated rows get the same score each.  Where the part
for the trees lacks a class, every score is the smoothed share of label 1; where the part for calibration does, the
trees' own probability is the score.  Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from dockside.llm.labelled import MAX_TRAIN_ROWS, held_out, training_rows
from dockside.plans.staging import stage

FOLDS, FOLD = 3, 1
THRESHOLD = 0.7
#: A lexicon term is in this share of the toxic texts at least, and so many times as frequent there as elsewhere.
MIN_SHARE, MIN_LIFT = 0.01, 20.0
_STEMS = (4, 5, 6)

# Second-person words of the languages covered.
SECOND_PERSON = frozenset(
    "you your yours yourself du dich dir dein deine ihr euch tu te toi vous votre ton tú ti usted ustedes vos".split()
)
_WORD = re.compile(r"[^\W\d_]+")
# A letter, digits or symbols that stand for letters, a letter.  Tried only where a run of letters begins, so a long word is read once.
_MASKED = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:[0-9@$*!|]++[^\W\d_]++)+")
_SPACED = re.compile(r"(?<!\w)[^\W\d_](?:[ .*_-][^\W\d_]){3,}(?!\w)")
_STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
_LETTERS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l", "*": None})
_NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
_NOT_LOWER = bytes(b for b in range(256) if not 97 <= b <= 122)
_SYMBOLS = bytes(b for b in range(256) if not (33 <= b < 127 and not chr(b).isalnum()))

FEATURES = (
    "log_words", "log_hits", "hit_density", "weight_density", "max_weight", "log_distinct_hits", "log_near_you",
    "near_you_density", "you_density", "upper_share", "shouted_share", "exclamations", "questions", "symbols",
    "masked_density", "stretched_density", "log_masked_hits",
)


def terms_of(word: str) -> list[str]:
    """The word itself, marked as whole, and its beginnings."""
    return [word + "$"] + [word[:k] for k in _STEMS if len(word) > k]


class Lexicon:
    """Weights of terms; a word's weight is the largest of its terms, none is zero."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.begin = {t.rstrip("$")[:4] for t in weights}

    def weight(self, word: str) -> float:
        return max((self.weights.get(t, 0.0) for t in terms_of(word)), default=0.0)

    def hits(self, words) -> dict[str, float]:
        begin = self.begin
        found = {w: self.weight(w) for w in words if w[:4] in begin}
        return {w: x for w, x in found.items() if x}


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The dense features in the order of :data:`FEATURES`."""
    raw, low = text.encode("utf-8", "replace"), text.lower()
    words = _WORD.findall(low)
    n, distinct = max(len(words), 1), set(words)
    hits = lexicon.hits(distinct)
    at = [i for i, w in enumerate(words) if w in hits] if hits else []
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON] if distinct & SECOND_PERSON else []
    near = 0
    if at and you:
        place = np.searchsorted(you, at)
        padded = np.array([-100, *you, 10**9])
        near = int((np.minimum(np.array(at) - padded[place], padded[place + 1] - at) <= 5).sum())
    masked = _MASKED.findall(low)
    hidden = [m.translate(_LETTERS) for m in masked] + ["".join(filter(str.isalpha, m)) for m in _SPACED.findall(low)]
    stretched = _STRETCHED.findall(low)
    if stretched:
        hidden += [w for m in _WORD.findall(_STRETCHED.sub(r"\1", low)) if (w := m) not in distinct]
    upper, lower = len(raw.translate(None, _NOT_UPPER)), len(raw.translate(None, _NOT_LOWER))
    shouted = sum(w.isupper() and len(w) > 2 for w in _WORD.findall(text)) if upper * 10 > lower else 0
    weights = [hits[words[i]] for i in at]
    return [
        np.log1p(len(words)), np.log1p(len(at)), len(at) / n, sum(weights) / n, max(weights, default=0.0),
        np.log1p(len(hits)), np.log1p(near), near / n, len(you) / n, upper / max(upper + lower, 1), shouted / n,
        text.count("!") / n, text.count("?") / n, len(raw.translate(None, _SYMBOLS)) / n, len(masked) / n,
        len(stretched) / n, np.log1p(len(lexicon.hits(set(hidden)))),
    ]


def draw_lexicon(rows: DataFrame, *, min_share: float = MIN_SHARE, min_lift: float = MIN_LIFT) -> Lexicon:
    """The lexicon of labelled texts ``rows(text, label)``."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met: dict[bool, Counter] = {True: Counter(), False: Counter()}
        for frame in frames:
            for text, label in zip(frame["text"], frame["label"]):
                met[label > 0].update({t for w in set(_WORD.findall(text.lower())) for t in terms_of(w)} | {""})
        terms = [*met[True].keys() | met[False].keys()]
        yield pd.DataFrame({"term": pd.Series(terms, dtype=object), "toxic": [met[True][t] for t in terms], "clean": [met[False][t] for t in terms]})

    counted = rows.select("text", "label").mapInPandas(count, "term string, toxic long, clean long")
    counted = stage(counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "toxic-terms")
    whole = counted.where("term = ''").first()  # every text has the empty term
    if whole is None:
        return Lexicon({})
    toxic, clean = whole["toxic"], whole["clean"]
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    kept = counted.where((F.col("toxic") >= max(3, min_share * toxic)) & (weight >= float(np.log(min_lift))) & (F.col("term") != ""))
    return Lexicon({r["term"]: r["weight"] for r in kept.select("term", weight.alias("weight")).collect()})


def feature_column(spark, lexicon: Lexicon, text: str = "text") -> Column:
    shared = spark.sparkContext.broadcast(lexicon)

    @F.pandas_udf("array<double>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([features(t, shared.value) for t in batch])

    return vectors(F.coalesce(F.col(text), F.lit("")))


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    share: float
    trees: GBTClassificationModel | None
    curve: IsotonicRegressionModel | None

    def score(self, docs: DataFrame) -> DataFrame:
        """doc_id and ``score`` of every document."""
        ids = docs.select("doc_id", "text")
        if self.trees is None:
            return ids.select("doc_id", F.lit(self.share).alias("score"))
        vectors = ids.select("doc_id", array_to_vector(feature_column(docs.sparkSession, self.lexicon)).alias("x"))
        found = self.trees.transform(vectors).select("doc_id", vector_to_array("probability")[1].alias("p1"))
        if self.curve is None:
            return found.select("doc_id", F.col("p1").alias("score"))
        return self.curve.transform(found).select("doc_id", F.col("calibrated").alias("score"))


def _two_classes(rows: DataFrame) -> bool:
    return rows.select("label").distinct().count() == 2


def train(
    docs: DataFrame, labels: DataFrame, *, label: str = "toxic", folds: int = FOLDS, fold: int = FOLD,
    max_rows: int = MAX_TRAIN_ROWS, rounds: int = 20, depth: int = 4,
) -> ToxicityModel:
    known = training_rows(docs, labels, label, folds=folds, fold=fold, max_rows=max_rows)
    known = known.withColumn("label", (F.col("label") > 0).cast("double"))
    known = stage(known.withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(10))), "toxic-sample")
    toxic, n = known.agg(F.coalesce(F.sum("label"), F.lit(0.0)), F.count("*")).first()
    lexicon = draw_lexicon(known.where("part < 5"))
    vectors = known.where("part >= 5").select("part", "label", feature_column(docs.sparkSession, lexicon).alias("f"))
    vectors = stage(vectors, "toxic-features").select("part", "label", array_to_vector("f").alias("x"))
    grown, rest = vectors.where("part < 8").coalesce(4), vectors.where("part >= 8")
    share = (toxic + 1) / (n + 2)
    if not _two_classes(grown):
        return ToxicityModel(lexicon, share, None, None)
    trees = GBTClassifier(
        featuresCol="x", labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=0.2,
        minInstancesPerNode=3, seed=5,
    ).fit(grown)
    if not _two_classes(rest):
        return ToxicityModel(lexicon, share, trees, None)
    scored = trees.transform(rest).select("label", vector_to_array("probability")[1].alias("p1"))
    curve = IsotonicRegression(featuresCol="p1", labelCol="label", predictionCol="calibrated").fit(scored)
    return ToxicityModel(lexicon, share, trees, curve)


def classify(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, **fitting) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = train(docs, labels, **fitting).score(docs)
    folds, fold = fitting.get("folds", FOLDS), fitting.get("fold", FOLD)
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
