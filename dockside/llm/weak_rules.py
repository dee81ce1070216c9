"""Quality rules by weak supervision.

Each rule votes for or against a document or abstains.  Expectation maximisation over the counts of vote patterns
estimates how often each rule is right about good and about bad documents, and the posterior probability of good
replaces a filter that every rule must pass.

One pass reads the texts and writes figures and votes, a few numbers a document.  There are at most 3^rules patterns,
so their counts, over all documents, are what the driver sees, whatever the corpus.

Edge cases: a null text has no words.  A text without words has zero in every figure and fails the base rules.  Repeated
rows are judged, and counted, each.  Very long texts are read whole; the vocabulary rule sees them in blocks.  Under 20 words the
sentence rule abstains, for shares of so few say nothing.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from dockside.plans.staging import stage

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
WHITE = " \t\n\r\x0b\x0c"
_NOT_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_ENDS = [a + b for a in (b".", b"?", b"!") for b in (b" ", b"\n")]
_NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
_NOT_LOWER = bytes(b for b in range(256) if not 97 <= b <= 122)


@dataclass(frozen=True)
class Rule:
    """Votes 1 from ``low`` to ``high``, -1 outside ``outer_low`` to ``outer_high``, and abstains otherwise."""

    name: str
    figure: str
    outer_low: float = -np.inf
    outer_high: float = np.inf
    low: float = np.inf
    high: float = -np.inf

    def votes(self, x: np.ndarray) -> np.ndarray:
        good = (x >= self.low) & (x <= self.high)
        bad = (x < self.outer_low) | (x > self.outer_high)
        return np.where(good, 1, np.where(bad, -1, 0))  # no figure (nan): abstains


RULES = (
    Rule("sentences", "sentence_ends", outer_low=0.01, outer_high=0.4, low=0.02, high=0.3),
    Rule("word_length", "word_length", outer_low=2, outer_high=14),
    Rule("symbols", "symbols_per_word", outer_high=0.1),
    Rule("duplicate_lines", "dup_line_share", outer_high=0.4),
    Rule("repeated_words", "repeat_share", outer_high=0.4),
    Rule("capitals", "upper_share", outer_high=0.4),
    Rule("letters", "letter_share", outer_low=0.7),
    Rule("alphabetic", "wordless_share", outer_high=0.2),  # eight words in ten have a letter or digit
    Rule("vocabulary", "distinct_share", outer_low=0.12),
)
#: Words that the share of distinct ones is taken over: it falls with a text's length, so longer texts are cut evenly.
VOCABULARY_WORDS = 2_000
#: A rule is taken to vote against no more than this share of good documents.
MAX_FALSE_ALARM = 0.01


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in some window found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    names: dict[bytes, int] = {}
    codes = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    key = codes[:n]
    for k in range(1, window):
        # Numbers of the shorter windows, dense again, so the product stays small.
        _, key = np.unique(key * len(names) + codes[k:n + k], return_inverse=True)
    again = np.bincount(key)[key] > 1
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k:n + k] |= again
    return int(covered.sum())


def distinct_words(words: list[bytes], block: int = VOCABULARY_WORDS) -> int:
    """Distinct words, summed over the fewest equal blocks of at most ``block`` words."""
    blocks = max(1, -(-len(words) // block))
    cuts = [len(words) * k // blocks for k in range(blocks + 1)]
    return sum(len(set(words[lo:hi])) for lo, hi in zip(cuts, cuts[1:]))


def measure(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines with a word, distinct words of blocks, letters, A-Z, a-z, sentence ends, words of punctuation."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    chars = len(text) - sum(map(text.count, WHITE))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if line.strip(WHITE):
            lines += 1
            dup += line in seen
            seen.add(line)
    letters = raw.translate(None, _NOT_LETTERS)
    upper, lower = len(raw.translate(None, _NOT_UPPER)), len(raw.translate(None, _NOT_LOWER))
    ends = sum(map(raw.count, _ENDS)) + raw.endswith((b".", b"?", b"!"))
    wordless = len(words) - len(raw.translate(None, _PUNCTUATION).split())
    repeated, distinct = repeated_words(words), distinct_words(words)
    return len(words), chars, symbols, dup, repeated, lines, distinct, len(letters.decode()), upper, lower, ends, wordless


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def figures(rows: pd.DataFrame) -> pd.DataFrame:
    words, cased = rows["n_words"].replace(0, np.nan), (rows["upper"] + rows["lower"]).replace(0, np.nan)
    return pd.DataFrame({
        "sentence_ends": (rows["ends"] / words).where(rows["n_words"] >= 20),
        "word_length": rows["word_chars"] / words,
        "symbols_per_word": rows["n_symbols"] / words,
        "dup_line_share": rows["n_dup_lines"] / rows["lines"].replace(0, np.nan),
        "repeat_share": rows["n_repeat_words"] / words,
        "upper_share": rows["upper"] / cased,
        "letter_share": rows["letters"] / rows["word_chars"].replace(0, np.nan),
        "wordless_share": rows["wordless"] / words,
        "distinct_share": rows["distinct"] / words,
    })


def vote(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the base figures, and ``pattern``: the votes as digits to base three, the first rule's lowest."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [*_COUNTS, "lines", "distinct", "letters", "upper", "lower", "ends", "wordless"]
        for frame in frames:
            rows = pd.DataFrame([measure(t) for t in frame["text"]], columns=names, dtype="int64")
            x = figures(rows)
            pattern = sum((r.votes(x[r.figure].to_numpy()) + 1) * 3**k for k, r in enumerate(rules))
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), **rows[_COUNTS], "pattern": pattern})

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", pattern long"
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInPandas(read, schema)


def unpack(patterns: np.ndarray, n_rules: int) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(n_rules)[None] % 3 - 1


@dataclass(frozen=True)
class VoteModel:
    """Share of good documents, and for each rule how often it votes -1, 0 and 1 on good and on bad documents."""

    prior: float
    on_good: np.ndarray  # (rules, 3)
    on_bad: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        rule = np.arange(votes.shape[1])[None]
        good = np.log(self.prior) + np.log(self.on_good)[rule, votes + 1].sum(axis=1)
        bad = np.log1p(-self.prior) + np.log(self.on_bad)[rule, votes + 1].sum(axis=1)
        return 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))


def expectation_maximisation(
    votes: np.ndarray, counts: np.ndarray, *, max_false_alarm: float = MAX_FALSE_ALARM, rounds: int = 500, tolerance: float = 1e-8
) -> VoteModel:
    """Fits a :class:`VoteModel` to vote patterns and their counts.

    It starts from rules that are right more often than not, and pseudo-counts of ten votes a rule keep them so where
    there are few data.
    """
    n = votes.shape[1]
    start_good, start_bad = np.tile([0.01, 0.49, 0.5], (n, 1)), np.tile([0.3, 0.6, 0.1], (n, 1))
    model = VoteModel(0.8, start_good, start_bad)
    cast = np.stack([votes == v for v in (-1, 0, 1)], axis=2)  # (patterns, rules, 3)
    for _ in range(rounds):
        p = model.posterior(votes)
        good, bad = counts * p, counts * (1 - p)
        on_good = np.einsum("p,prv->rv", good, cast) + 10 * start_good
        on_bad = np.einsum("p,prv->rv", bad, cast) + 10 * start_bad
        on_good /= on_good.sum(axis=1, keepdims=True)
        on_bad /= on_bad.sum(axis=1, keepdims=True)
        alarm = np.minimum(on_good[:, :1], max_false_alarm)
        on_good = np.hstack([alarm, on_good[:, 1:] * (1 - alarm) / on_good[:, 1:].sum(axis=1, keepdims=True)])
        new = VoteModel((good.sum() + 8) / (counts.sum() + 10), on_good, on_bad)
        moved = max(abs(new.prior - model.prior), np.abs(new.on_good - model.on_good).max(), np.abs(new.on_bad - model.on_bad).max())
        model = new
        if moved < tolerance:
            break
    return model


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, threshold: float = 0.5) -> DataFrame:
    """doc_id, the base figures, base_failed, probability, kept of every document."""
    voted = stage(vote(docs, rules), "quality-votes")
    seen = voted.groupBy("pattern").count().orderBy("pattern").collect()  # at most 3^rules rows
    patterns = np.array([r["pattern"] for r in seen], np.int64)
    counts = np.array([r["count"] for r in seen], np.float64)
    votes = unpack(patterns, len(rules))
    model = expectation_maximisation(votes, counts)
    table = docs.sparkSession.createDataFrame(
        [(int(p), float(x)) for p, x in zip(patterns, model.posterior(votes))], "pattern long, probability double"
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return voted.join(F.broadcast(table), "pattern").select(
        "doc_id", *_COUNTS, failed.alias("base_failed"), "probability",
        (~failed & (F.col("probability") >= threshold)).alias("kept"),
    )
