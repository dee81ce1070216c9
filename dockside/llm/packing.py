"""Packing of tokenised documents into sequences of fixed length, with certified bin counts.

Documents become pieces of at most ``capacity`` ids.  Pieces are dealt into partitions of bounded size, and each
partition is packed best-fit decreasing.  A lower bound from dual feasible functions tells for each partition whether
its bins are as few as can be; such a partition is certified and left alone.  Partitions with a gap give up their
bins that are not full, exchange what was in them, and pack again, until nothing is left to gain.

Only lengths and identities move; ids are read from the text again where they are wanted.

Edge cases: a null or empty text has no ids but the end id, so it is one piece of length one.  Repeated rows are
pieces of their own.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from dockside.plans.staging import stage

CAPACITY = 4096
END_ID = 1
#: Words a worker remembers the ids of; then it starts anew.
CACHED_WORDS = 500_000
#: Pieces that one task packs at once.
PARTITION_PIECES = 30_000
#: Rounds of exchange between partitions whose bin count is not certified.
MAX_ROUNDS = 4


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: A lower-case Latin word and the ASCII punctuation behind it: two pre-tokens whatever stands around them.
_PLAIN = re.compile("([a-zß-öø-ÿ]+)([.,!?;:#$%&*]*)")
_BYTE_CHARS = {
    b: chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174 else None for b in range(256)
}
for _n, _b in enumerate(b for b in range(256) if _BYTE_CHARS[b] is None):
    _BYTE_CHARS[_b] = chr(256 + _n)


class WordTokenizer:
    """Ids of whole texts, by way of the ids of their words.

    Exact for tokenizers that drop white space and never merge across it: each word between ASCII white space is
    encoded once and remembered; a text that holds one of the tokenizer's special tokens is encoded whole.  Folding A-Z first is exact where both forms are in NFC, for the tokenizer lower-cases
    each character; other texts keep their case and the tokenizer folds it.
    """

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.cached_words = cached_words
        self._forget()

    def _forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.flat, self.starts = array("I"), array("q", [0])

    def _word(self, word: bytes) -> list[int]:
        if word.isalpha():  # ASCII letters
            return [t.id for t in self.model.tokenize(word.lower().decode())]
        text = word.decode()
        if plain := _PLAIN.fullmatch(text.lower()):
            parts = (p.encode().decode("latin-1").translate(_BYTE_CHARS) for p in plain.groups() if p)
            return [t.id for p in parts for t in self.model.tokenize(p)]
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _place(self, word: bytes) -> int:
        """Where the ids of the word are; they are put there first if need be."""
        at = self.index.get(word)
        if at is None:
            stem = word[:-1]
            if word[-1] in b",." and stem.isalpha():  # two pre-tokens
                first, second = self._place(stem), self._place(word[-1:])
                ids = [*self.flat[self.starts[first]:self.starts[first + 1]]]
                ids += self.flat[self.starts[second]:self.starts[second + 1]]
            else:
                ids = self._word(word)
            at = self.index[word] = len(self.starts) - 1
            self.flat.extend(ids)
            self.starts.append(len(self.flat))
        return at

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):  # a token of its own wherever it stands, also inside a word
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        folded = text.encode().lower()
        if not text.isascii() and not (
            unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", folded.decode())
        ):
            folded = text.encode()
        words = folded.split()
        if not words:
            return np.empty(0, "<u4")
        if len(self.index) > self.cached_words:
            self._forget()
        at = list(map(self.index.get, words))
        if None in at:
            at = [self._place(w) if i is None else i for w, i in zip(words, at)]
        at = np.array(at, np.int64)
        starts = np.frombuffer(self.starts, np.int64)
        flat = np.frombuffer(self.flat, np.uint32)
        begin, end = starts[at], starts[at + 1]
        lengths = end - begin
        ends = np.cumsum(lengths)
        out = flat[np.arange(ends[-1]) + np.repeat(begin - (ends - lengths), lengths)]
        del starts, flat  # the arrays can't grow while they are exported
        return out


_tokenizers: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def pieces(
    docs: DataFrame, tokenizer: str | None = None, *, capacity: int = CAPACITY, end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): every document's ids and the end id, cut at ``capacity``."""
    path = tokenizer or default_tokenizer()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = _tokenizer(path)
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame["doc_id"].tolist(), frame["text"].tolist()):
                ids = np.append(tok.ids(text or ""), np.uint32(end_id)).astype("<u4")
                for k, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    row = (doc_id, k, start, len(part), zlib.crc32(part.tobytes()))
                    rows.append((*row, part.astype(np.int64)) if with_ids else row)
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInPandas(
        cut, schema
    )


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Fewest bins that any packing needs, by two families of dual feasible functions over the counts of lengths."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1].astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int(count @ size) // capacity)
    above = np.cumsum(count[::-1])[::-1]  # how many are at least so long
    weight = np.cumsum(count * size)
    for a in range(1, capacity // 2 + 1):  # longer than capacity - a: a bin; shorter than a: nothing
        large = int(above[capacity - a + 1])
        best = max(best, large - (-int(weight[capacity - a] - weight[a - 1]) // capacity))
    for k in range(1, 21):  # floor((k + 1) x) / k, x itself where (k + 1) x is whole
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, k * size, scaled // capacity * capacity)
        best = max(best, -(-int(count @ value) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each length, all in descending order: each goes where it leaves least room."""
    bins = np.empty(len(lengths), np.int64)
    rooms: list[int] = []  # rooms that some bin has, ascending
    having: dict[int, list[int]] = {}
    used = 0
    for k, need in enumerate(lengths.tolist()):
        at = bisect.bisect_left(rooms, need)
        if at == len(rooms):
            bin_id, room = used, capacity
            used += 1
        else:
            room = rooms[at]
            bin_id = having[room].pop()
            if not having[room]:
                del having[room], rooms[at]
        bins[k] = bin_id
        if (left := room - need) > 0:
            if left not in having:
                having[left] = []
                bisect.insort(rooms, left)
            having[left].append(bin_id)
    return bins


_KEYS = ["doc_id", "piece", "start", "length", "ids_crc32"]
_PACKED = "part long, doc_id long, piece int, start long, length long, ids_crc32 long, bin long, settled boolean"


def _pack_partitions(dealt: DataFrame, capacity: int, last: bool) -> DataFrame:
    """Packs every ``part``; rows of certified partitions and of full bins are settled, or all in the last round.

    ``before`` is the bin of the round before.  Bins are dealt whole, so a partition that gains nothing keeps them.
    """

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(
            ["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], ignore_index=True
        )
        lengths = frame["length"].to_numpy(np.int64)
        bins = best_fit_decreasing(lengths, capacity)
        if (frame["before"] >= 0).all():
            old, names = pd.factorize(frame["before"])
            if len(names) <= bins.max() + 1:
                bins = old.astype(np.int64)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        certified = len(fill) == lower_bound(lengths, capacity)
        frame["bin"] = bins
        frame["settled"] = last or certified or fill[bins] == capacity
        return frame[["part", *_KEYS, "bin", "settled"]]

    return dealt.groupBy("part").applyInPandas(pack, _PACKED)


def _bin_number(part: str = "part", bin_: str = "bin") -> Column:
    """Partition and bin as one number: a partition has fewer than 2^24 bins."""
    return F.shiftleft(F.col(part), 24) + F.col(bin_)


def pack(
    items: DataFrame, *, capacity: int = CAPACITY, partition_pieces: int = PARTITION_PIECES,
    max_rounds: int = MAX_ROUNDS,
) -> DataFrame:
    """Items of :func:`pieces` with ``sequence_id`` and ``offset``.

    A partition holds about ``partition_pieces`` items, whatever their keys: items are dealt by a hash of the whole
    row, later whole bins by a hash of their number.  Every item is settled in exactly one round, and a round's
    result is a written table, so a lost executor can't repack what others have read.
    """
    loose = stage(items.select(*_KEYS, F.lit(-1).cast("long").alias("before")), "pack-items")
    # Copies of one row go to different partitions too.
    deal = F.xxhash64(*_KEYS, F.monotonically_increasing_id())
    n, settled = loose.count(), None
    for r in range(max_rounds):
        parts = max(1, -(-n // partition_pieces))
        last = r == max_rounds - 1 or parts == 1
        dealt = loose.withColumn("part", F.pmod(deal, F.lit(parts)))
        out = stage(_pack_partitions(dealt, capacity, last), f"pack-round-{r}")
        number = F.shiftleft(F.lit(r).cast("long"), 58) + _bin_number()
        done = out.where("settled").select(*_KEYS, number.alias("sequence_id"))
        settled = done if settled is None else settled.unionByName(done)
        loose = out.where(~F.col("settled")).select(*_KEYS, _bin_number().alias("before"))
        n = 0 if last else loose.count()
        if not n:
            break
        deal = F.xxhash64(F.lit(r), "before")
    return _offsets(settled)


def _offsets(placed: DataFrame) -> DataFrame:
    w = (
        Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "doc_id", "piece", "ids_crc32")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return placed.withColumn("offset", F.sum("length").over(w) - F.col("length"))


def sequences(docs: DataFrame, placed: DataFrame, tokenizer: str | None = None, **cut) -> DataFrame:
    """(sequence_id, ids): the packed ids themselves.

    Rows that agree in all of doc_id, piece, start and ids_crc32 have the same ids, so each is matched with any one.
    """
    keys = ["doc_id", "piece", "start", "ids_crc32"]
    with_ids = pieces(docs, tokenizer, with_ids=True, **cut).select(*keys, "ids").dropDuplicates(keys)
    on = [placed[k].eqNullSafe(with_ids[k]) for k in keys]
    return (
        placed.join(with_ids, on).groupBy("sequence_id")
        .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x.ids)).alias("ids"))
    )


def pack_documents(docs: DataFrame, tokenizer: str | None = None, *, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    return pack(pieces(docs, tokenizer, capacity=capacity), capacity=capacity)
