"""Cross-entropy difference of matched models of words.

A target and a background corpus give two models of the same order and smoothing over one shared vocabulary, the words
(and single marks) of both corpora.  A word's count is smoothed by the probability of its spelling, from a model of byte
trigrams of the same corpus, so no word is unknown to either.  The background's counts are scaled to the target's amount
of text, so both models smooth alike.  A text's score is the mean over its words of the target's loss less the
background's: the lower, the more it is like the target.

Counts cover every word of both corpora; a task sums its own before the shuffle.  The vocabulary grows with the corpora
and stays a table: each document's distinct words are joined with it by 64-bit hash.  Only the spelling model, at most
256^3 entries and some 10^5 in text, reaches the driver and is broadcast.  The spelling model can be used alone, on whole
texts, by :func:`fit` and :func:`score`.

Edge cases: a null or empty text has no tokens and null losses and score.  Repeated rows count, and are scored, each.
With an empty target or background its model is uniform over bytes.  Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from dockside.plans.staging import stage

_CODES = 1 << 24
_CHUNK = 8_000_000
#: Two line feeds stand before every text.
_START = b"\n\n"
_WORD = re.compile(r"\w+|[^\w\s]")
#: Distinct words that a task holds before it passes their counts on.
_HELD_WORDS = 500_000


def trigrams(raw: bytes) -> np.ndarray:
    """A number below 2^24 for each byte: itself with the two before it."""
    b = np.frombuffer(_START + raw, np.uint8).astype(np.int32)
    return (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]


def _chunks(texts: Iterator[str]) -> Iterator[np.ndarray]:
    parts, n = [], 0
    for text in texts:
        parts.append(trigrams(text.encode("utf-8", "replace")))
        n += len(parts[-1])
        if n >= _CHUNK:
            yield np.concatenate(parts)
            parts, n = [], 0
    if parts:
        yield np.concatenate(parts)


def count_trigrams(texts: DataFrame, name: str) -> DataFrame:
    """(code, ``name``): each task's counts of trigrams; a code has a row for each task that met it."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(_CODES, np.int64)
        for codes in _chunks(t for frame in frames for t in frame["text"]):
            total += np.bincount(codes, minlength=_CODES)
        met = np.flatnonzero(total)
        for at in range(0, len(met), 100_000):
            part = met[at:at + 100_000]
            yield pd.DataFrame({"code": part.astype(np.int32), name: total[part]})

    return texts.select("text").where("text is not null").mapInPandas(count, f"code int, {name} long")


def log_probabilities(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of each trigram's last byte after the two before it; Witten-Bell smoothing by the shorter contexts."""
    uniform = 1 / 256
    ones = np.zeros(256)
    np.add.at(ones, codes & 255, counts)
    kinds = np.count_nonzero(ones)
    p1 = (ones + kinds * uniform) / max(ones.sum() + kinds, 1e-300) if kinds else np.full(256, uniform)
    twos = np.zeros(1 << 16)
    np.add.at(twos, codes & 0xFFFF, counts)
    follow = twos.reshape(256, 256)
    kinds2, total2 = (follow > 0).sum(axis=1), follow.sum(axis=1)
    p2 = np.where(
        (kinds2 > 0)[:, None], (follow + kinds2[:, None] * p1[None]) / np.maximum(total2 + kinds2, 1e-300)[:, None], p1[None]
    ).ravel()
    context = codes >> 8
    total3, kinds3 = np.zeros(1 << 16), np.zeros(1 << 16)
    np.add.at(total3, context, counts)
    np.add.at(kinds3, context, counts > 0)
    shorter = p2[codes & 0xFFFF]
    k, t = kinds3[context], total3[context]
    return np.log(np.where(k > 0, (counts + k * shorter) / np.maximum(t + k, 1e-300), shorter))


@dataclass(frozen=True)
class LossTable:
    """Losses in nats of the two models for every trigram that either corpus has, by ascending code.

    One entry more than codes: a trigram that neither corpus has costs both models the uniform loss.
    """

    codes: np.ndarray
    target: np.ndarray
    background: np.ndarray

    def places(self) -> np.ndarray:
        dense = np.full(_CODES, len(self.codes), np.int32)
        dense[self.codes] = np.arange(len(self.codes), dtype=np.int32)
        return dense


def fit(target: DataFrame, background: DataFrame) -> LossTable:
    """Models of two tables with a ``text`` column."""
    return _losses(count_trigrams(target, "n").withColumn("m", F.lit(0).cast("long")).unionByName(
        count_trigrams(background, "m").withColumn("n", F.lit(0).cast("long"))
    ))


def _losses(counted: DataFrame) -> LossTable:
    found = counted.groupBy("code").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).toArrow()
    codes = found["code"].to_numpy().astype(np.int64)
    order = np.argsort(codes)
    codes, n, m = codes[order], found["n"].to_numpy()[order].astype(float), found["m"].to_numpy()[order].astype(float)
    matched = m * (n.sum() / m.sum()) if n.sum() and m.sum() else m
    losses = (np.append(-log_probabilities(codes, counts), np.log(256)) for counts in (n, matched))
    return LossTable(codes.astype(np.int32), *losses)


def score(docs: DataFrame, table: LossTable) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss (nats a token), score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        places = own.places()
        for frame in frames:
            rows = []
            for text in frame["text"]:
                at = places[trigrams(text.encode("utf-8", "replace"))]
                n = max(len(at), 1)
                rows.append((len(at), own.target[at].sum() / n, own.background[at].sum() / n))
            out = pd.DataFrame(rows, columns=["n_tokens", "target_loss", "background_loss"])
            out.insert(0, "doc_id", frame["doc_id"].astype("Int64"))
            yield out

    read_docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found = read_docs.mapInPandas(read, "doc_id long, n_tokens long, target_loss double, background_loss double")
    some = F.col("n_tokens") > 0
    losses = [F.when(some, F.col(c)).alias(c) for c in ("target_loss", "background_loss")]
    return found.select("doc_id", "n_tokens", *losses, F.when(some, F.col("target_loss") - F.col("background_loss")).alias("score"))


def cross_entropy_difference(docs: DataFrame, target: DataFrame) -> DataFrame:
    """Scores ``docs`` by a model of ``target`` against one of ``docs`` themselves."""
    return score(docs, fit(target, docs))


def words(text: str) -> list[str]:
    return _WORD.findall(text)


def count_words(texts: DataFrame, name: str) -> DataFrame:
    """(word, ``name``): each task's counts of words; a word has a row or a few for each task that met it."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[str] = Counter()

        def counted() -> Iterator[pd.DataFrame]:
            out = pd.DataFrame({"word": list(total.keys()), name: np.fromiter(total.values(), np.int64, len(total))})
            total.clear()
            for at in range(0, len(out), 100_000):
                yield out[at:at + 100_000]

        for frame in frames:
            for text in frame["text"]:
                total.update(words(text))
                if len(total) >= _HELD_WORDS:
                    yield from counted()
        yield from counted()

    return texts.select("text").where("text is not null").mapInPandas(count, f"word string, {name} long")


def _spelled(found: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of the words, each with a line feed behind it, and where each word's begin."""
    raw = [w.encode("utf-8", "replace") for w in found]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
    codes = trigrams(_START.join(raw) + _START)
    begin = np.cumsum(sizes + 1) - sizes - 1
    return np.delete(codes, begin + sizes), np.cumsum(sizes) - sizes


def _count_spellings(vocabulary: DataFrame) -> DataFrame:
    """(code, n, m): the trigrams of the words, weighted by the words' counts."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                codes, begin = _spelled(frame["word"])
                sizes = np.diff(np.append(begin, len(codes)))
                met, at = np.unique(codes, return_inverse=True)
                sums = (np.bincount(at, np.repeat(frame[c].to_numpy(float), sizes)).astype(np.int64) for c in ("n", "m"))
                yield pd.DataFrame({"code": met, **dict(zip("nm", sums))})

    return vocabulary.mapInPandas(count, "code int, n long, m long")


def fit_words(target: DataFrame, background: DataFrame) -> DataFrame:
    """(key, target, background): the losses in nats of every word of either table, by the hash of the word."""
    none = F.lit(0).cast("long")
    vocabulary = stage(
        count_words(target, "n").withColumn("m", none).unionByName(count_words(background, "m").withColumn("n", none))
        .groupBy("word").agg(F.sum("n").alias("n"), F.sum("m").alias("m")),
        "words",
    )
    sums = vocabulary.agg(*[f(c) for c in ("n", "m") for f in (F.sum, lambda c: F.count_if(F.col(c) > 0))]).first()
    n_all, n_kinds, m_all, m_kinds = (float(x or 0) for x in sums)
    scale = n_all / m_all if n_all and m_all else 1.0
    shared = vocabulary.sparkSession.sparkContext.broadcast(_losses(_count_spellings(vocabulary)))

    def loss(counts: np.ndarray, all_: float, kinds: float, spelling: np.ndarray) -> np.ndarray:
        if not kinds:
            return spelling
        with np.errstate(divide="ignore"):
            return np.log(all_ + kinds) - np.logaddexp(np.log(counts), np.log(kinds) - spelling)

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        places = own.places()
        for frame in frames:
            if len(frame):
                codes, begin = _spelled(frame["word"])
                at = places[codes]
                yield pd.DataFrame({
                    "word": frame["word"],
                    "target": loss(frame["n"].to_numpy(float), n_all, n_kinds, np.add.reduceat(own.target[at], begin)),
                    "background": loss(
                        frame["m"].to_numpy(float) * scale, m_all * scale, m_kinds, np.add.reduceat(own.background[at], begin)
                    ),
                })

    judged = vocabulary.mapInPandas(judge, "word string, target double, background double")
    return stage(judged.select(F.xxhash64("word").alias("key"), "target", "background"), "word-losses")


def _distinct_words(docs: DataFrame) -> DataFrame:
    """(row, doc_id, word, n): the words of every row and how often it has each; a row without any has a null word."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lo in range(0, len(frame), 500):
                part = frame[lo:lo + 500]
                found, n, sizes = [], [], []
                for text in part["text"]:
                    own = Counter(words(text)) or {None: 0}
                    found.extend(own.keys())
                    n.extend(own.values())
                    sizes.append(len(own))
                yield pd.DataFrame({
                    "row": np.repeat(part["row"].to_numpy(), sizes),
                    "doc_id": part["doc_id"].astype("Int64").repeat(sizes).array, "word": found, "n": n,
                })

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.mapInPandas(read, "row long, doc_id long, word string, n int")


def word_cross_entropy_difference(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss (nats a word), score of ``docs`` by a model of ``target`` against one of ``docs``."""
    losses = fit_words(target, docs)
    # A row without words meets nothing, under a key of its own.
    key = F.when(F.col("word").isNull(), F.col("row")).otherwise(F.xxhash64("word"))
    met = _distinct_words(docs).select("row", "doc_id", key.alias("key"), "n").join(losses, "key", "left")
    tokens = F.sum("n")
    each = {c: F.when(tokens > 0, F.sum(F.col("n") * F.col(c)) / tokens) for c in ("target", "background")}
    return met.groupBy("row", "doc_id").agg(
        tokens.alias("n_tokens"), *[x.alias(f"{c}_loss") for c, x in each.items()]
    ).select("doc_id", "n_tokens", "target_loss", "background_loss", (F.col("target_loss") - F.col("background_loss")).alias("score"))
