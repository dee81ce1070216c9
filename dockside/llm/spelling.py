"""Spelling variants: words one edit apart, found by a bidirectional FM-index over the delimited vocabulary.

Two words that differ by one inserted, deleted or replaced code point agree in the first half of either or in its second
half.  The search scheme has two searches: match the first half exactly, from the word's begin, and extend to the right
across the other half allowing one error; or match the second half exactly, from the word's end, and extend to the left.
States of a search are intervals of suffix ranks, and the delimiters around every word of the indexed text keep matches to
whole words.  A pair that both would find counts for the first alone.

The vocabulary lies in blocks of bounded size, each with an index of its own: for the first search by the words' first
three code points, for the second by their last three, which any match shares.  The words of three letters that would fill
more than a block are dealt over several, and each of them asks in all of those.  A block returns one row a word, never
pairs.  Forms are followed to the last by doubling.

Words are counted by the tasks before the shuffle; the vocabulary is a table that grows with the corpus.

Edge cases: a null or empty text has no words.  A null id stands as an empty string before the colon.  Repeated rows count
each.  A word of any length is indexed whole: memory follows the longest word.  Ties of a form's count go to the smaller
word by code points.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from dockside.plans.staging import stage

LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A run's letter is left out where this number divides the hash of document and run.
SLIP = 199
#: A form has so many times the word's occurrences.
OUTWEIGHS = 5
#: Code points of delimited text in a block, about.
BLOCK = 100_000
#: Code points that route a word; at most half of the shortest word.
ROUTE = 3
#: Distinct words that a task holds before it passes their counts on.
_HELD_WORDS = 500_000
#: Every so many places of the text have their counts of symbols stored.
_STEP = 8
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_RUN = re.compile("[a-zÀ-ÿ]+")


def words_of(doc_id: int | None, text: str) -> Counter[str]:
    """Lower-cased runs of letters, some with a letter left out, and how often the text has each."""
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter[str] = Counter()
    for run, n in Counter(_RUN.findall(text.encode("utf-8", "replace").translate(_LOWER).decode())).items():
        if len(run) >= LEAST_LENGTH:
            h = zlib.crc32(run.encode(), head)
            if h % SLIP == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= LEAST_LENGTH:
                out[run] += n
    return out


def vocabulary(docs: DataFrame, *, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words with at least ``least`` occurrences."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[str] = Counter()

        def counted() -> Iterator[pd.DataFrame]:
            out = pd.DataFrame({"word": list(total.keys()), "n": np.fromiter(total.values(), np.int64, len(total))})
            total.clear()
            for at in range(0, len(out), 100_000):
                yield out[at:at + 100_000]

        for frame in frames:
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                total.update(words_of(doc_id, text))
                if len(total) >= _HELD_WORDS:
                    yield from counted()
        yield from counted()

    # An id as text stays whole where pandas would make a column with nulls floating.
    read = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text").where("text is not null")
    counts = read.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return stage(counts.where(F.col("n") >= least), "vocabulary")


class Direction:
    """Suffix ranks of a text of delimited words, read one way: intervals are extended by one symbol at a time."""

    def __init__(self, text: np.ndarray, symbols: int):
        n, step = len(text), 1
        kinds, rank = np.unique(text, return_inverse=True)
        while len(kinds) < n:  # ranks of rotations by their first 2 * step symbols
            if step >= n:
                raise ValueError("indexed words must be distinct")
            kinds, rank = np.unique(rank * n + np.roll(rank, -step), return_inverse=True)
            step *= 2
        self.at = np.empty(n, np.int64)
        self.at[rank] = np.arange(n)
        self.before = text[self.at - 1]
        bins = -(-n // _STEP)
        per = np.bincount(np.arange(n) // _STEP * symbols + self.before, minlength=bins * symbols).reshape(bins, symbols)
        self.stored = np.concatenate((np.zeros((1, symbols), np.int32), np.cumsum(per, axis=0, dtype=np.int32)))
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))[:-1]
        self.padded = np.concatenate((self.before, np.full(2 * _STEP, -1)))

    def counts(self, upto: np.ndarray) -> np.ndarray:
        """Of every symbol before the places ``upto`` of the transformed text: a row for each place."""
        out = self.stored[upto // _STEP].copy()
        rows, start = np.arange(len(upto)), upto // _STEP * _STEP
        for k in range(_STEP - 1):
            on = np.flatnonzero(start + k < upto)
            out[rows[on], self.padded[start[on] + k]] += 1
        return out

    def count_of(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Of one symbol for each place."""
        start = upto // _STEP * _STEP
        out = self.stored[upto // _STEP, symbol].astype(np.int64)
        for k in range(_STEP - 1):
            out += (start + k < upto) & (self.padded[start + k] == symbol)
        return out


class WordIndex:
    """A bidirectional index of distinct words, in a text where a delimiter stands before each and after the last."""

    def __init__(self, words: list[str]):
        points = [np.frombuffer(w.encode("utf-32-le"), "<u4") for w in words]
        sizes = np.fromiter(map(len, points), np.int64, len(points))
        self.alphabet, coded = np.unique(np.concatenate(points), return_inverse=True)
        self.text = np.zeros(int(sizes.sum()) + len(words), np.int64)
        self.begin = np.cumsum(sizes + 1) - sizes - 1  # of the delimiter before each word
        self.text[np.delete(np.arange(len(self.text)), self.begin)] = coded + 1
        self._way: dict[bool, Direction] = {}

    def way(self, right: bool) -> Direction:
        """The text reads as a ring, so the first delimiter follows the last word; extending to the right is extending the reversed text to the left."""
        if right not in self._way:
            self._way[right] = Direction(self.text[::-1] if right else self.text, len(self.alphabet) + 1)
        return self._way[right]

    def _coded(self, words: list[str], right: bool) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the words in reading order, a delimiter behind each; -1 for what the index doesn't have."""
        points = [np.frombuffer(w.encode("utf-32-le"), "<u4")[:: 1 if right else -1] for w in words]
        flat = np.concatenate([np.append(p, 0) for p in points]).astype(np.int64)
        sizes = np.fromiter(map(len, points), np.int64, len(points))
        at = np.minimum(np.searchsorted(self.alphabet, flat), len(self.alphabet) - 1)
        coded = np.where(self.alphabet[at] == flat, at + 1, -1)
        coded[np.cumsum(sizes + 1) - 1] = 0
        return coded, np.cumsum(sizes + 1) - sizes - 1

    def search(self, words: list[str], right: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, found): places in ``words`` and in the indexed words, of those one error apart beyond the exact half."""
        way = self.way(right)
        flat, begin = self._coded(words, right)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        exact = sizes // 2 if right else sizes - sizes // 2
        q = np.arange(len(words))
        lo, hi = np.zeros(len(words), np.int64), np.full(len(words), int((self.text == 0).sum()))  # all delimiters
        i, wrong = np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        found, steps = [], 0
        while len(q):
            steps += 1
            if steps % 16 == 0:  # several errors may lead to one state, as in a run of one letter
                state = np.unique(np.stack((q, i, lo, hi, wrong)), axis=1)
                q, i, lo, hi, wrong = *state[:4], state[4].astype(bool)
            p = flat[begin[q] + i]
            narrow = wrong | (i < exact[q])  # only the word's own symbol will do
            k = np.flatnonzero(narrow & (p >= 0))
            nlo, nhi = (way.first[p[k]] + way.count_of(p[k], x[k]) for x in (lo, hi))
            live = nlo < nhi
            k = k[live]
            nxt = [(q[k], nlo[live], nhi[live], i[k] + 1, wrong[k])]
            k = np.flatnonzero(~narrow)
            if len(k):
                below = way.counts(lo[k])
                row, c = np.nonzero(way.counts(hi[k]) - below)
                s = k[row]
                nlo = way.first[c] + below[row, c]
                nhi = way.first[c] + way.count_of(c, hi[s])
                same = c == p[s]
                other = (c != 0) & ~same
                nxt.append((q[s[same]], nlo[same], nhi[same], i[s[same]] + 1, wrong[s[same]]))
                put = other & (p[s] != 0)
                nxt.append((q[s[put]], nlo[put], nhi[put], i[s[put]] + 1, np.ones(put.sum(), bool)))  # replaced
                put = c != 0
                nxt.append((q[s[put]], nlo[put], nhi[put], i[s[put]], np.ones(put.sum(), bool)))  # one more in the found word
                s = k[p[k] != 0]
                nxt.append((q[s], lo[s], hi[s], i[s] + 1, np.ones(len(s), bool)))  # one less
            q, lo, hi, i, wrong = (np.concatenate(x) for x in zip(*nxt))
            over = (i > sizes[q]) & (hi > lo)
            done = np.flatnonzero(over & wrong)
            if len(done):
                found.append((q[done], self._word_at(way.at[lo[done]], right)))
            keep = ~over
            q, lo, hi, i, wrong = q[keep], lo[keep], hi[keep], i[keep], wrong[keep]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        pairs = np.unique(np.concatenate([a * len(self.begin) + b for a, b in found]))
        return pairs // len(self.begin), pairs % len(self.begin)

    def _word_at(self, place: np.ndarray, right: bool) -> np.ndarray:
        """The word of the delimiter found last: that before it to the left, that behind it to the right."""
        if right:  # the delimiter behind the word, by its place in the reversed text
            return np.searchsorted(self.begin, len(self.text) - 1 - place) - 1 + np.where(len(self.text) - 1 - place == 0, len(self.begin), 0)
        return np.searchsorted(self.begin, place)

    def near(self, words: list[str], indexed: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Both searches: every pair one edit apart, once."""
        pairs = [(q[ok], f[ok]) for right in (True, False) for q, f in [self.search(words, right)] for ok in [first_finder(words, indexed, q, f, right)]]
        return tuple(np.concatenate(x) for x in zip(*pairs))


def first_finder(words: list[str], indexed: list[str], q: np.ndarray, f: np.ndarray, right: bool) -> np.ndarray:
    """Whether this search is the first to find each pair: the other finds it too if both have the query's first half."""
    if right:
        return np.ones(len(q), bool)
    return np.fromiter((not indexed[b].startswith(words[a][:len(words[a]) // 2]) for a, b in zip(q, f)), bool, len(q))


def _asked(block: pd.DataFrame) -> pd.DataFrame:
    """(word, n_near, form, form_n) of a block's words that have near ones among its indexed words."""
    right = bool(block["to_right"].iloc[0])
    own = block[block["indexed"]]
    words, indexed = block["word"].tolist(), own["word"].tolist()
    none = pd.DataFrame({"word": pd.Series(dtype=str), "n_near": pd.Series(dtype="int64"), "form": pd.Series(dtype=str), "form_n": pd.Series(dtype="int64")})
    if not indexed:
        return none
    q, f = WordIndex(indexed).search(words, right)
    ok = first_finder(words, indexed, q, f, right)
    q, f = q[ok], f[ok]
    if not len(q):
        return none
    order = np.empty(len(indexed), np.int64)
    order[sorted(range(len(indexed)), key=indexed.__getitem__)] = np.arange(len(indexed))
    n = own["n"].to_numpy()
    at = np.lexsort((order[f], -n[f], q))
    q, f = q[at], f[at]
    first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
    return pd.DataFrame({
        "word": [words[k] for k in q[first]], "n_near": np.diff(np.append(first, len(q))),
        "form": [indexed[k] for k in f[first]], "form_n": n[f[first]],
    })


def near_words(vocab: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """(word, n_near, form, form_n): the near words' number and the one of largest n, of words that have any."""
    size = F.char_length("word") + 1
    sides = F.array(
        F.struct(F.lit(True).alias("to_right"), F.substring("word", 1, ROUTE).alias("route")),
        F.struct(F.lit(False).alias("to_right"), F.substring("word", -ROUTE, ROUTE).alias("route")),
    )
    routed = vocab.select("word", "n", F.explode(sides).alias("x")).select("word", "n", "x.*")
    sizes = stage(routed.groupBy("to_right", "route").agg(F.ceil(F.sum(size) / block).cast("int").alias("cells")), "routes")
    blocks = max(1, int((vocab.agg(F.sum(size)).first()[0] or 0) // block))
    placed = lambda cell: F.pmod(F.xxhash64("route", cell), F.lit(blocks))
    own = placed(F.pmod(F.xxhash64("word"), F.col("cells")).cast("int"))
    # Several cells of a route may fall into one block; a word asks there once, or its near words would count for each.
    every = F.array_distinct(F.transform(F.sequence(F.lit(0), F.col("cells") - 1), placed))
    dealt = routed.join(sizes, ["to_right", "route"]).select("to_right", "word", "n", own.alias("own"), F.explode(every).alias("block")).select(
        "to_right", "block", "word", "n", (F.col("own") == F.col("block")).alias("indexed")
    )
    asked = dealt.groupBy("to_right", "block").applyInPandas(_asked, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))).alias("x")
    return asked.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("x.form").alias("form"), (-F.col("x.less")).alias("form_n")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form, by doubling; counts rise along a chain, so there are no rings."""
    roots = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        roots = stage(roots.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), "ahead"), "roots")
        if not roots.where("ahead is not null").limit(1).count():
            return roots.select("word", "root")
        roots = roots.select("word", "root")


def variants(docs: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    vocab = vocabulary(docs)
    held = F.col("form_n") >= OUTWEIGHS * F.col("n")
    found = stage(vocab.join(near_words(vocab, block=block), "word", "left").select(
        "word", F.when(held, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(held, F.col("form_n")).alias("form_n"),
    ), "near-words")
    roots = _roots(found.where("form is not null"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
