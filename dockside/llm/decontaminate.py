"""Benchmark decontamination: passages of documents within an edit distance of benchmark items.

Texts are sequences of lower-cased words.  A window as long as an item is embedded by the CGK random walk, which stays
at a word or goes on as a random bit of that word says, so few edits between two sequences leave most places of their
walks equal.  Repeated sampling of places gives hash keys: windows and items that agree on a key become candidates,
and the least number of word edits to any stretch of the text there is computed exactly.  Each length of item has its own
number of repetitions, the smallest that reaches the target recall on items of that length edited as far as the limit.

Windows that can't lie within the limit are not embedded.  That test loses nothing: n words within d edits of an item
share at least n - 1 - 2 d neighbouring pairs of words with it.

Long items would need ever more repetitions.  Items of over ``WALK_WORDS`` words, and of lengths that miss the target
within ``MAX_REPETITIONS``, are not embedded but found by the same argument for runs of q words, of which n - q + 1 - q d
stay: every stretch that has so many of an item's runs, and its share of pairs, is verified.  This loses nothing.

Items are few beside the documents, and are taken in blocks of bounded size, each block a pass over all documents.

Edge cases: null texts are empty and match nothing.  Items of fewer than five words (one shingle) are no evidence and
are not searched.  Repeated documents give a row each, as do repeated items of different ids.  An empty table on either
side gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Edits allowed for each word of an item: similarity 0.8 or more.
MAX_EDITS = 0.2
TARGET_RECALL = 0.97
SAMPLED = 3
MIN_WORDS = 5
#: Items of one pass over the documents; their index is broadcast, a few hundred bytes an item.
BLOCK_ITEMS = 20_000
#: Characters of the items of one pass, about: long items make more blocks.
BLOCK_CHARS = 16_000_000
#: Lengths that need more repetitions than this are searched exactly, as are items of more words than these.
MAX_REPETITIONS = 128
WALK_WORDS = 40
#: Longest run of words that is looked up, and (run, item) pairs that are held at once.
_MAX_RUN = 8
_HELD_PAIRS = 1 << 20
_SPACES = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256))
_BATCH_WORDS = 1 << 20
_GRAM_BITS = 22
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(_SPACES).split()


def allowed(n, share: float = MAX_EDITS):
    """Edits that an item of n words may be away."""
    return np.floor(np.asarray(n) * share + 1e-9).astype(np.int64)


def least_edits(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the stretch of ``text`` nearest to ``item``; of equal ones the first to start, then end."""
    one = np.int64(1) << 40
    steps = np.arange(len(text) + 1, dtype=np.int64)
    row = steps.copy()  # cost and start in one number; nothing of the item read yet
    for code in item:
        new = np.empty_like(row)
        new[0] = row[0] + one
        new[1:] = np.minimum(row[:-1] + one * (text != code), row[1:] + one)
        row = np.minimum.accumulate(new - steps * one) + steps * one
    end = int(np.argmin(row))
    return int(row[end] >> 40), int(row[end] & (one - 1)), end


class ItemIndex:
    """Benchmark items of one block, hashed by their embeddings."""

    def __init__(
        self, items: list[tuple[int, str | None]], *, max_edits: float = MAX_EDITS, recall: float = TARGET_RECALL,
        sampled: int = SAMPLED, min_words: int = MIN_WORDS, seed: int = 11,
    ):
        split = [(i, words(t)) for i, t in items]
        split = [(i, w) for i, w in split if len(w) >= min_words]
        self.max_edits, self.sampled = max_edits, sampled
        self.ids = [i for i, _ in split]
        self.vocabulary: dict[bytes, int] = {}
        for _, w in split:
            for x in w:
                self.vocabulary.setdefault(x, len(self.vocabulary) + 1)
        self.items = [np.array([self.vocabulary[x] for x in w], np.int64) for _, w in split]
        if not self.items:
            return
        sizes = np.array([len(x) for x in self.items], np.int64)
        short = np.unique(sizes[sizes <= WALK_WORDS])
        rng = np.random.default_rng(seed)
        self.longest = int(short[-1]) if len(short) else 0
        shape = (MAX_REPETITIONS, 2 * self.longest)
        self.factors = rng.integers(0, 1 << 63, shape, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.places = rng.random((MAX_REPETITIONS, sampled))
        enough = {n: self._enough(n, np.flatnonzero(sizes == n), recall, rng) for n in short.tolist()}
        #: By length; a length without them is searched exactly.
        self.repetitions: dict[int, int] = {n: r for n, r in enough.items() if r is not None}
        self.lengths = np.array(list(self.repetitions), np.int64)
        walked = np.isin(sizes, self.lengths)
        self._post(np.flatnonzero(~walked), sizes)
        if not len(self.lengths):
            return
        shortest = int(self.lengths[0])
        self.longest = int(self.lengths[-1])
        self.grams = np.zeros(1 << _GRAM_BITS, bool)
        for k in np.flatnonzero(walked).tolist():
            self.grams[self._gram(self.items[k])] = True
        # Pairs that a window of each length must share, and what that leaves for some window of the least length.
        self.need = np.maximum(self.lengths - 1 - 2 * allowed(self.lengths, max_edits), 1)
        whole, rest = np.divmod(self.lengths, shortest)
        self.width = shortest
        self.least = max(1, int(np.maximum(np.ceil((self.need - rest) / whole), np.ceil(self.need / (whole + (rest > 0)))).min()) - 1)
        self.tables = [self._table(r) for r in range(max(self.repetitions.values()))]

    def _gram(self, codes: np.ndarray) -> np.ndarray:
        pair = codes[:-1].astype(np.uint64) * np.uint64(0x1FFFFFFFFFFFFF) + codes[1:].astype(np.uint64)
        return (pair * _MIX >> np.uint64(64 - _GRAM_BITS)).astype(np.int64)

    def _walks(self, codes: np.ndarray, starts: np.ndarray, r: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """Word and place in windows up to ``longest``, by step and start; ``codes`` go on for ``self.longest`` behind each."""
        read = np.empty((2 * longest, len(starts)), np.int64)
        place = np.empty_like(read)
        at = np.zeros(len(starts), np.int64)
        for t in range(2 * longest):
            place[t] = at
            word = codes[starts + np.minimum(at, self.longest)]
            read[t] = word
            at = at + ((word.astype(np.uint64) + np.uint64(1)) * self.factors[r, t] * _MIX >> np.uint64(63)).astype(np.int64)
        return read, place

    def _keys(self, read: np.ndarray, place: np.ndarray, length: int, r: int, of: np.ndarray) -> np.ndarray:
        """Hash of the sampled places of each window of this length, for the starts ``of``."""
        key = np.full(len(of), length, np.uint64)
        for u in self.places[r]:
            t = int(u * 2 * length)
            word = np.where(place[t, of] < length, read[t, of], -1)
            key = (key ^ (word.astype(np.uint64) + np.uint64(2))) * _MIX
            key ^= key >> np.uint64(29)
        return key

    def _table(self, r: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        out = {}
        for length, enough in self.repetitions.items():
            if enough <= r:
                continue
            of = [k for k, x in enumerate(self.items) if len(x) == length]
            codes = np.concatenate([np.append(self.items[k], np.zeros(self.longest + 1, np.int64)) for k in of])
            starts = np.arange(len(of)) * (length + self.longest + 1)
            keys = self._keys(*self._walks(codes, starts, r, length), length, r, np.arange(len(of)))
            order = np.argsort(keys, kind="stable")
            out[length] = keys[order], np.array(of, np.int64)[order]
        return out

    def _enough(self, length: int, of: np.ndarray, recall: float, rng: np.random.Generator, trials: int = 300) -> int | None:
        """Repetitions after which the wanted share of the items ``of`` a length, edited as far as the limit, has met its original."""
        chosen = of[rng.integers(0, len(of), trials)]
        texts, starts = [], []
        at = 0
        for k in chosen:
            x = self.items[k].tolist()
            for _ in range(int(allowed(length, self.max_edits))):
                p, kind = int(rng.integers(0, max(len(x), 1))), int(rng.integers(0, 3))
                other = int(rng.integers(0, len(self.vocabulary) + 1))
                x[p:p + (kind != 1)] = [other] * (kind != 2)
            before = rng.integers(0, len(self.vocabulary) + 1, 2).tolist()
            texts.append(np.array(before + x + [0] * (2 * self.longest + 2), np.int64))
            starts.append(at + np.arange(5))
            at += len(texts[-1])
        codes, starts = np.concatenate(texts), np.concatenate(starts)
        whole = np.concatenate([np.append(self.items[k], np.zeros(self.longest + 1, np.int64)) for k in chosen])
        own = np.arange(trials) * (length + self.longest + 1)
        met = np.zeros(trials, bool)
        for r in range(MAX_REPETITIONS):
            there = self._keys(*self._walks(codes, starts, r, length), length, r, np.arange(len(starts))).reshape(-1, 5)
            here = self._keys(*self._walks(whole, own, r, length), length, r, np.arange(trials))
            met |= (there == here[:, None]).any(axis=1)
            if met.mean() >= recall:
                return r + 1
        return None

    @staticmethod
    def _runs(codes: np.ndarray, q: int) -> np.ndarray:
        """Hash of the ``q`` words from each place on; none for the last q - 1."""
        n = max(len(codes) - q + 1, 0)
        key = np.zeros(n, np.uint64)
        for k in range(q):
            key = (key ^ codes[k:k + n].astype(np.uint64)) * _MIX
            key ^= key >> np.uint64(29)
        return key

    def _post(self, exact: np.ndarray, sizes: np.ndarray) -> None:
        """For each q the items that are searched by runs of q words: their runs, and which items have each."""
        d = allowed(sizes, self.max_edits)
        run = np.ones_like(sizes)
        for q in range(2, _MAX_RUN + 1):
            run[sizes - q + 1 - q * d >= 1] = q
        self.sizes, self.kept_runs = sizes, np.maximum(sizes - run + 1 - run * d, 1)
        self.postings: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, int]] = {}
        for q in np.unique(run[exact]).tolist():
            of = exact[run[exact] == q]
            own = [np.unique(self._runs(self.items[k], q)) for k in of.tolist()]
            keys, items = np.concatenate(own), np.repeat(of, [len(x) for x in own]).astype(np.int32)
            order = np.argsort(keys, kind="stable")
            keys, first = np.unique(keys[order], return_index=True)
            self.postings[q] = keys, np.append(first, len(items)), items[order], int((sizes + d)[of].max())

    def exact_spans(self, codes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, start, end) of parts of texts that hold every stretch within the limit of an item searched exactly."""
        out = [np.empty((3, 0), np.int64)]
        for q, (keys, first, items, reach) in self.postings.items():
            run = self._runs(codes, q)
            known = np.concatenate(([0], np.cumsum(codes > 0)))
            at = np.flatnonzero(known[q:] - known[:-q] == q) if len(run) else np.empty(0, np.int64)
            place = np.minimum(np.searchsorted(keys, run[at]), len(keys) - 1)
            hit = keys[place] == run[at]
            at, place = at[hit], place[hit]
            many = first[place + 1] - first[place]
            upto = np.cumsum(many)
            lo = 0
            while lo < len(at):
                # Runs that begin here, and those behind them that a stretch may reach.
                hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] - many[lo] + _HELD_PAIRS, "right")))
                end = int(np.searchsorted(at, at[min(hi, len(at)) - 1] + reach))
                n = many[lo:end]
                p = np.repeat(at[lo:end], n)
                k = items[np.arange(n.sum()) + np.repeat(first[place[lo:end]] - np.cumsum(n) + n, n)].astype(np.int64)
                order = np.lexsort((p, k))
                p, k = p[order], k[order]
                last = np.minimum(np.arange(len(p)) + self.kept_runs[k] - 1, len(p) - 1)
                longest = self.sizes[k] + allowed(self.sizes[k], self.max_edits)
                text = np.searchsorted(begin, p, "right") - 1
                enough = (np.arange(len(p)) + self.kept_runs[k] <= len(p)) & (k[last] == k) & (p[last] + q - p <= longest)
                enough &= p[last] < begin[text + 1]
                some = np.flatnonzero(enough)
                text = text[some]
                out.append(np.stack([
                    k[some], np.maximum(p[last[some]] + q - longest[some], begin[text]),
                    np.minimum(p[some] + longest[some], begin[text + 1] - 1),
                ]))
                lo = hi
        item, lo, hi = np.concatenate(out, axis=1)
        return item, lo, hi

    def _may_hold(self, k: int, codes: np.ndarray) -> bool:
        """Whether some stretch has the pairs that one within the limit of the item keeps; loses nothing."""
        n, d = int(self.sizes[k]), int(allowed(self.sizes[k], self.max_edits))
        upto = np.concatenate(([0], np.cumsum(np.isin(self._runs(codes, 2), self._runs(self.items[k], 2)))))
        width = min(n + d - 1, len(upto) - 1)
        return int((upto[width:] - upto[:len(upto) - width]).max()) >= n - 1 - 2 * d

    def candidates(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, item) pairs whose keys agree in some repetition."""
        none = np.empty(0, np.int64)
        if not len(self.lengths):
            return none, none
        codes = np.append(codes, np.zeros(2 * self.longest + 2, np.int64))
        hit = np.zeros(len(codes), np.int32)
        known = np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0))
        hit[known + 1] = self.grams[self._gram_at(codes, known)]
        upto = np.cumsum(hit)  # pairs that end here or before
        last = len(codes) - 2 * self.longest - 2
        dense = np.flatnonzero(upto[self.width - 1:last + self.width - 1] - upto[:last] >= self.least)
        if not len(dense):
            return none, none
        near = np.zeros(last + 1, np.int32)
        np.add.at(near, np.maximum(dense - (self.longest - self.width), 0), 1)
        np.add.at(near, dense + 1, -1)
        starts = np.flatnonzero(np.cumsum(near[:last]) > 0)
        fits = upto[starts[:, None] + self.lengths[None] - 1] - upto[starts][:, None] >= self.need[None]
        some = fits.any(axis=1)
        starts, fits = starts[some], fits[some]
        if not len(starts):
            return none, none
        of_length = [np.flatnonzero(fits[:, j]) for j in range(len(self.lengths))]
        found_at, found = [], []
        for r, table in enumerate(self.tables):
            left = [(n, of) for n, of in zip(self.lengths.tolist(), of_length) if len(of) and n in table]
            if not left:
                continue
            wanted = np.unique(np.concatenate([of for _, of in left]))
            walks = self._walks(codes, starts[wanted], r, left[-1][0])
            for length, of in left:
                keys, items = table[length]
                got = self._keys(*walks, length, r, np.searchsorted(wanted, of))
                lo, hi = np.searchsorted(keys, got), np.searchsorted(keys, got, "right")
                more = np.flatnonzero(hi > lo)
                n = hi[more] - lo[more]
                found_at.append(np.repeat(starts[of[more]], n))
                found.append(items[np.repeat(lo[more] - np.cumsum(n) + n, n) + np.arange(n.sum())])
        pairs = np.unique(np.stack([np.concatenate(found_at), np.concatenate(found)]), axis=1)
        return pairs[0], pairs[1]

    def _gram_at(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        pair = codes[at].astype(np.uint64) * np.uint64(0x1FFFFFFFFFFFFF) + codes[at + 1].astype(np.uint64)
        return (pair * _MIX >> np.uint64(64 - _GRAM_BITS)).astype(np.int64)

    def matches(self, texts: list[list[bytes]]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item id, edits, start word, end word): the nearest stretch for each text and item within the limit."""
        code = self.vocabulary.get
        sizes = np.array([len(t) for t in texts], np.int64)
        begin = np.concatenate(([0], np.cumsum(sizes + 1)))  # a word that no item has behind each text
        codes = np.zeros(begin[-1], np.int64)
        for b, t in zip(begin.tolist(), texts):
            codes[b:b + len(t)] = np.fromiter(map(code, t, repeat(0)), np.int64, len(t))
        at, item = self.candidates(codes)
        text = np.searchsorted(begin, at, "right") - 1
        d = allowed(self.sizes[item], self.max_edits)
        more, more_lo, more_hi = self.exact_spans(codes, begin)
        lo = np.concatenate((np.maximum(at - d, begin[text]), more_lo))
        hi = np.concatenate((np.minimum(at + self.sizes[item] + 2 * d, begin[text] + sizes[text]), more_hi))
        item = np.concatenate((item, more))
        text = np.concatenate((text, np.searchsorted(begin, more_lo, "right") - 1))
        order = np.lexsort((lo, item, text))
        groups: dict[tuple[int, int], list[list[int]]] = {}
        for t, k, a, z in zip(*(x[order].tolist() for x in (text, item, lo, hi))):
            spans = groups.setdefault((t, k), [])
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(z, spans[-1][1])
            else:
                spans.append([a, z])
        for (t, k), spans in groups.items():
            spans = [(lo, hi) for lo, hi in spans if self._may_hold(k, codes[lo:hi])]
            if not spans:
                continue
            best = min((e, lo + s - begin[t], lo + z - begin[t]) for lo, hi in spans for e, s, z in [least_edits(self.items[k], codes[lo:hi])])
            if best[0] <= allowed(len(self.items[k]), self.max_edits):
                yield t, self.ids[k], int(best[0]), int(best[1]), int(best[2])


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[list[bytes]]]]:
    for frame in frames:
        ids, texts, n = [], [], 0
        for doc_id, text in zip(frame["doc_id"].tolist(), frame["text"].tolist()):
            ids.append(doc_id)
            texts.append(words(text))
            n += len(texts[-1])
            if n >= _BATCH_WORDS:
                yield ids, texts
                ids, texts, n = [], [], 0
        if ids:
            yield ids, texts


def _search(docs: DataFrame, index: ItemIndex) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["doc_id", "item_id", "edits", "start_word", "end_word"]
        for ids, texts in _batches(frames):
            rows = [(ids[t], *rest) for t, *rest in shared.value.matches(texts)]
            yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInPandas(
        find, "doc_id long, item_id long, edits int, start_word long, end_word long"
    )


def _blocks(items: DataFrame, block_items: int) -> int:
    n, chars = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    return max(1, -(-n // block_items), -(-chars // BLOCK_CHARS))


def contamination(docs: DataFrame, benchmark: DataFrame, *, block_items: int = BLOCK_ITEMS, **options) -> DataFrame:
    """(doc_id, item_id, edits, start_word, end_word): each document and the items that it has a passage of."""
    spark: SparkSession = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    blocks = _blocks(items, block_items)
    out = None
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        rows = block.distinct().orderBy("item_id", "text").collect()
        index = ItemIndex([(r["item_id"], r["text"]) for r in rows], **options)
        found = _search(docs, index) if index.items else spark.createDataFrame(
            [], "doc_id long, item_id long, edits int, start_word long, end_word long"
        )
        out = found if out is None else out.unionByName(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a passage of the benchmark, with all their columns.

    Each row is judged by its own text, in the pass that reads it, so no join is needed.
    """
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    block_items = options.pop("block_items", BLOCK_ITEMS)
    blocks = _blocks(rows, block_items)
    for k in range(blocks):
        block = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else rows
        items = [(r["item_id"], r["text"]) for r in block.distinct().orderBy("item_id", "text").collect()]
        index = ItemIndex(items, **options)
        if index.items:
            docs = docs.where(~_has_match(docs.sparkSession, index)(F.coalesce(F.col("text"), F.lit(""))))
    return docs


def _has_match(spark: SparkSession, index: ItemIndex):
    shared = spark.sparkContext.broadcast(index)

    @F.pandas_udf("boolean")
    def has(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            hit = np.zeros(len(batch), bool)
            base = 0
            for ids, texts in _batches([pd.DataFrame({"doc_id": 0, "text": batch})]):
                for t, *_ in shared.value.matches(texts):
                    hit[base + t] = True
                base += len(ids)
            yield pd.Series(hit)

    return has
