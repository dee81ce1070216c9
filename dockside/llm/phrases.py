"""Collocations by a weighted de Bruijn graph of words.

Texts fall into pieces at punctuation and line ends, pieces into words.  The nodes of a language's graph are runs of three
words; a run of four words, the longest gram, is an edge between two nodes that overlap in two words, weighted by its
occurrences.  Shorter counts are not gathered from the texts again: a node's count is the flow that leaves it plus the
pieces that end with it, a pair's is the flow of the nodes that it begins plus the pieces that end with it, a word's
likewise.  Strong edges, those that can be candidates, are compacted: a node with one strong edge in and one out lies
inside a path, and a path, in stretches of bounded length, tells for each shorter phrase on it the heaviest longest gram
around, so one row stands for what every edge alone would repeat.

A candidate is a phrase of two to four words with at least ``least`` occurrences.  Cutting it in two gives the parts'
counts l and r and a score, floor(2000000 * a / (l + r)); its weakest cut counts.  Candidates that lie inside a longer one
with nearly as many occurrences are dropped.

Tasks count their own edges in chunks of bounded size before the shuffle, and counts travel packed, those of a bucket of
nodes in one row; buckets are as many as the texts' bytes ask for.  Only words and frequent phrases are kept as a
table; nothing of the corpus is broadcast by hand or collected.

Edge cases: a null or empty text has no words; a null language is ``und``, together with texts that say so.  Repeated rows
count each.  Texts are cut into chunks anywhere between pieces, so a very long one needs no more memory.  Ties of score and
count go by phrase.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from dockside.plans.staging import stage

LEAST = 30
#: Words of the longest gram.
LONGEST = 4
TOP = 2000
SCALE = 2_000_000
#: A candidate goes if a longer one around it has at least so many hundredths of its occurrences.
COVERED = 80
#: Bytes of text that a task holds of a language before it passes their edges on.
CHUNK_BYTES = 5_000_000
#: Bytes of text whose grams share a bucket, about.
BUCKET_BYTES = 4_000_000
#: Edges of a path that meet in one row.
STRETCH = 64
_CUT = b".,;:!?\n\x0b\x0c\r"
_LOWER = bytes.maketrans(bytes(range(65, 91)) + b"\t" + _CUT, bytes(range(97, 123)) + b" " + b"." * len(_CUT))


def prepared(text: str) -> bytes:
    """A text in lower case, words parted by spaces alone and a full stop at every end of a piece."""
    return text.encode("utf-8", "replace").translate(_LOWER) + b"."


def _places(parts: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket for every row of word hashes; the hash 0 stands for no word."""
    h = np.full(len(parts[0]), np.uint64(0x9E3779B97F4A7C15))
    for part in parts:
        h = (h ^ part) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
    return (h % np.uint64(buckets)).astype(np.int64)


def _packed(lang: str, bucket: np.ndarray, grams: pa.Array, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, grams, n): one row for each bucket, its grams joined by line feeds, their counts as longs."""
    order = np.argsort(bucket, kind="stable")
    edge = np.flatnonzero(np.concatenate(([True], np.diff(bucket[order]) != 0, [True]))) if len(bucket) else np.zeros(1, np.int64)
    taken = grams.take(pa.array(order))
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(edge, pa.int32()), taken), "\n")
    counts = [n[order[lo:hi]].astype("<i8").tobytes() for lo, hi in zip(edge, edge[1:])]
    rows = pa.table({"lang": pa.array([lang] * len(counts), pa.string()), "bucket": pa.array(bucket[order[edge[:-1]]], pa.int64()),
                     "grams": joined, "n": pa.array(counts, pa.binary())})
    yield from rows.to_batches(max_chunksize=64)


def _unpacked(rows: pa.Table) -> tuple[pa.Array, np.ndarray]:
    """Distinct grams and their summed counts."""
    grams = pa.chunked_array([pc.split_pattern(x, "\n").flatten() for x in rows["grams"].chunks if len(x)])
    n = np.frombuffer(b"".join(rows["n"].to_pylist()), "<i8")
    summed = pa.table({"g": grams, "n": n}).group_by("g").aggregate([("n", "sum")])
    return summed["g"].combine_chunks(), summed["n_sum"].to_numpy()


def _halves(grams: pa.Array, mark: str) -> tuple[pa.Array, pa.Array]:
    """What stands before the mark, and after it (null where it has none)."""
    cut = pc.split_pattern(grams, mark, max_splits=1)
    front = pc.list_element(cut, 0)
    two = pc.equal(pc.list_value_length(cut), 2)
    back = pc.if_else(two, pc.list_element(pc.if_else(two, cut, pa.scalar(["", ""], cut.type)), 1), pa.scalar(None, grams.type))
    return front, back


def _edges(raw: bytes, lang: str, buckets: int) -> Iterator[pa.RecordBatch]:
    """Packed edges ``a b<CR>c<TAB>d``, nodes that end a piece, ``a b<CR>c``, and pieces of one or two words."""
    ids, words = pd.factorize(np.array(raw.replace(b".", b" . ").split(), dtype=object), sort=True)
    stop = int(np.flatnonzero(words == b".")[0])
    ends = np.flatnonzero(ids == stop)
    left = ends[np.searchsorted(ends, np.arange(len(ids)))] - np.arange(len(ids))  # words up to the piece's end
    begins = np.concatenate(([True], ids[:-1] == stop))
    start = np.flatnonzero((left >= 3) | (begins & (left > 0)))
    if not len(start):
        return
    none = len(words)
    padded = np.concatenate((ids, np.full(4, stop))).astype(np.int64)
    gram = [np.where(left[start] > k, padded[start + k], none) for k in range(LONGEST)]
    pairs = [np.unique(a * (none + 1) + b, return_inverse=True) for a, b in (gram[:2], gram[2:])]
    both, n = np.unique(pairs[0][1].astype(np.int64) * len(pairs[1][0]) + pairs[1][1], return_counts=True)
    front, back = pairs[0][0][both // len(pairs[1][0])], pairs[1][0][both % len(pairs[1][0])]
    each = (front // (none + 1), front % (none + 1), back // (none + 1), back % (none + 1))
    hashes = np.append(pd.util.hash_array(words, categorize=False), np.uint64(0))
    spelled = pa.array([*words.tolist(), None], pa.binary()).cast(pa.string())
    a, b, c, d = (spelled.take(pa.array(x)) for x in each)
    skip = {"null_handling": "skip"}
    grams = pc.binary_join_element_wise(pc.binary_join_element_wise(pc.binary_join_element_wise(a, b, " ", **skip), c, "\r", **skip), d, "\t", **skip)
    yield from _packed(lang, _places([hashes[x] for x in each[:3]], buckets), grams, n)


def count_edges(docs: DataFrame, buckets: int) -> DataFrame:
    """(lang, bucket, grams, n): each task's counts; the bucket goes by the node."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = defaultdict(list)
        size: dict[str, int] = defaultdict(int)

        def flushed(lang: str) -> Iterator[pa.RecordBatch]:
            size.pop(lang)
            yield from _edges(b"".join(held.pop(lang)), lang, buckets)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own, done = prepared(text.as_py()), 0
                while len(own) - done > CHUNK_BYTES:  # a piece is never cut
                    cut = own.find(b".", done + CHUNK_BYTES) + 1 or len(own)
                    yield from _edges(own[done:cut], lang, buckets)
                    done = cut
                held[lang].append(own[done:])
                size[lang] += len(own) - done
                if size[lang] >= CHUNK_BYTES:
                    yield from flushed(lang)
        for lang in list(held):
            if size[lang]:
                yield from flushed(lang)

    read = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text")).where("text is not null")
    return read.mapInArrow(count, _PACKED)


_PACKED = "lang string, bucket long, grams string, n binary"


def _hashed(phrases: pa.Array) -> np.ndarray:
    return pd.util.hash_array(np.array(phrases.to_pylist(), dtype=object), categorize=False)


def _merged(parts: list[tuple[pa.Array, np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
    """One row for each phrase of several lists; null phrases go."""
    every = pa.table({"g": pa.chunked_array([g for g, _ in parts]), "n": np.concatenate([n for _, n in parts])})
    summed = every.filter(pc.is_valid(every["g"])).group_by("g").aggregate([("n", "sum")])
    return summed["g"].combine_chunks(), summed["n_sum"].to_numpy()


def _repacked(lang: str, parts: list[tuple[pa.Array, np.ndarray]], buckets: int) -> pa.Table:
    grams, n = _merged(parts)
    order = pc.sort_indices(grams)  # likeness of neighbours makes them small
    grams, n = grams.take(order), n[order.to_numpy()]
    batches = list(_packed(lang, _places([_hashed(grams)], buckets), grams, n))
    return pa.Table.from_batches(batches) if batches else pa.table({"lang": pa.array([], pa.string()), "bucket": pa.array([], pa.int64()), "grams": pa.array([], pa.string()), "n": pa.array([], pa.binary())})


def phrase_counts(docs: DataFrame, *, least: int = LEAST) -> DataFrame:
    """(lang, phrase, words, n): every word, and the phrases of two to four words that occur ``least`` times.

    Counts travel packed, many to a row.  A round sums what meets in a bucket and passes on what it gives to shorter phrases;
    no more than one count for each phrase and bucket.
    """
    volume = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + volume // BUCKET_BYTES

    def nodes(rows: pa.Table) -> pa.Table:
        """Of edges: the strong ones, strong nodes by their flow, what nodes and piece ends give to pairs, piece ends to words."""
        grams, n = _unpacked(rows)
        node, last = _halves(grams, "\t")
        pair, third = _halves(node, "\r")
        ends, edge, long_ = pc.is_null(last).to_numpy(False), pc.is_valid(last).to_numpy(False), pc.is_valid(third).to_numpy(False)
        flow, of_flow = _merged([(node.filter(pa.array(long_)), n[long_])])
        strong = edge & (n >= least)
        phrase = lambda x: pc.replace_substring(pc.replace_substring(x, "\r", " "), "\t", " ")
        first, second = _halves(pair, " ")
        two = pc.is_valid(second).to_numpy(False)
        closing = ends & long_  # a node ends the piece, and with it a pair
        tail = pc.binary_join_element_wise(second, third, " ").filter(pa.array(closing))
        return _repacked(rows["lang"][0].as_py(), [
            (phrase(grams.filter(pa.array(strong))), n[strong]),
            (phrase(flow.filter(pa.array(of_flow >= least))), of_flow[of_flow >= least]),
            (pair.filter(pa.array(two)), n[two]),
            (tail, n[closing]),
            (pc.coalesce(third, second, first).filter(pa.array(ends)), n[ends]),
        ], buckets)

    def pairs(rows: pa.Table) -> pa.Table:
        """Of sums for pairs, words and strong phrases: those, but for rare pairs, and what pairs give to their first words."""
        grams, n = _unpacked(rows)
        spaces = pc.count_substring(grams, " ").to_numpy()
        keep = (spaces != 1) | (n >= least)
        two = spaces == 1
        first, _ = _halves(grams.filter(pa.array(two)), " ")
        return _repacked(rows["lang"][0].as_py(), [(grams.filter(pa.array(keep)), n[keep]), (first, n[two])], buckets)

    def whole(rows: pa.Table) -> pa.Table:
        grams, n = _unpacked(rows)
        k = pc.add(pc.count_substring(grams, " "), 1).cast(pa.int32())
        return pa.table({"lang": pa.array([rows["lang"][0].as_py()] * len(n), pa.string()), "phrase": grams, "words": k, "n": pa.array(n, pa.int64())})

    packed = count_edges(docs, buckets)
    for step in (nodes, pairs):
        packed = packed.groupBy("lang", "bucket").applyInArrow(step, _PACKED)
    return stage(packed.groupBy("lang", "bucket").applyInArrow(whole, "lang string, phrase string, words int, n long"), "phrase-counts")


def _words(phrase: str | Column) -> Column:
    return F.split(phrase, " ")


def _joined(words: Column, start: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def compact(strong: DataFrame) -> DataFrame:
    """(lang, path, place, phrase, n): each strong edge's path, and how many edges of the path come after it.

    ``strong`` has (lang, phrase, n), phrases of four words.  Links through nodes with one strong edge in and one out are
    followed by doubling, each round a written table.  Paths are told by their last edge; an edge on a ring without an end
    is a path of its own.
    """
    ends = strong.select(
        "lang", "phrase", "n", _joined(_words("phrase"), 1, 3).alias("from_node"), _joined(_words("phrase"), 2, 3).alias("to_node")
    )
    inner = ends.select("lang", F.col("from_node").alias("node"), F.lit(1).alias("leaves"), F.lit(0).alias("enters"), "phrase").unionByName(
        ends.select("lang", F.col("to_node").alias("node"), F.lit(0).alias("leaves"), F.lit(1).alias("enters"), F.lit(None).alias("phrase"))
    ).groupBy("lang", "node").agg(F.sum("leaves").alias("o"), F.sum("enters").alias("i"), F.max("phrase").alias("next")).where("o = 1 and i = 1")
    inner = inner.select("lang", F.col("node").alias("to_node"), "next")
    at = stage(ends.join(inner, ["lang", "to_node"], "left").select(
        "lang", "phrase", "n", F.col("next").alias("ahead"), F.coalesce("next", "phrase").alias("path"),
        F.when(F.col("next").isNull(), 0).otherwise(1).cast("long").alias("place"),
    ), "paths")
    moving = before = -1
    while True:
        moving = at.where("ahead is not null").count()
        if moving in (0, before):  # what still moves after a round without an end runs in rings
            break
        before = moving
        far = at.select("lang", F.col("phrase").alias("ahead"), F.col("ahead").alias("ahead2"), F.col("path").alias("path2"), F.col("place").alias("place2"))
        at = stage(at.join(far, ["lang", "ahead"], "left").select(
            "lang", "phrase", "n", F.col("ahead2").alias("ahead"), F.coalesce("path2", "path").alias("path"),
            (F.col("place") + F.coalesce("place2", F.lit(0))).alias("place"),
        ), "paths")
    ring = F.col("ahead").isNotNull()
    return at.select("lang", F.when(ring, F.col("phrase")).otherwise(F.col("path")).alias("path"),
                     F.when(ring, 0).otherwise(F.col("place")).alias("place"), "phrase", "n")


def heaviest_around(strong: DataFrame) -> DataFrame:
    """(lang, phrase, around): for every pair and triple of words inside strong edges, the most occurrences of an edge that has it.

    Paths are read in stretches of ``STRETCH`` edges; the largest over all stretches counts.
    """
    stretch = (
        compact(strong).groupBy("lang", "path", F.floor(F.col("place") / STRETCH).alias("stretch"))
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("place")).alias("at"), "phrase", "n"))).alias("e"))
    )
    words = F.concat(_words(F.col("e")[0]["phrase"]), F.transform(F.slice("e", 2, STRETCH), lambda x: F.element_at(_words(x["phrase"]), -1)))
    row = stretch.select("lang", words.alias("w"), F.transform("e", lambda x: x["n"]).alias("n"))

    def inside(k: int) -> Column:
        """Phrases of k words: that at word j lies in the edges from j - (4 - k) to j."""
        first = lambda j: F.greatest(j - (LONGEST - k), F.lit(0))
        last = lambda j: F.least(j, F.size("n") - 1)
        return F.transform(F.sequence(F.lit(0), F.size("w") - k), lambda j: F.struct(
            F.array_join(F.slice("w", j + 1, k), " ").alias("phrase"),
            F.array_max(F.slice("n", first(j) + 1, last(j) - first(j) + 1)).alias("around"),
        ))

    return row.select("lang", F.explode(F.concat(inside(2), inside(3))).alias("x")).select("lang", "x.*").groupBy("lang", "phrase").agg(F.max("around").alias("around"))


def collocations(docs: DataFrame, *, least: int = LEAST, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` candidates of each language."""
    counts = phrase_counts(docs, least=least)
    in_all = counts.where("words = 1").groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = counts.where(F.col("n") >= least)
    candidates = frequent.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))

    triples = frequent.where("words = 3")
    around = heaviest_around(frequent.where(F.col("words") == LONGEST).select("lang", "phrase", "n")).unionByName(
        triples.select("lang", F.explode(F.array(_joined(_words("phrase"), 1, 2), _joined(_words("phrase"), 2, 2))).alias("phrase"), F.col("n").alias("around"))
    ).groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    held = candidates.join(around, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (F.lit(100) * wide("around") < F.lit(covered) * wide("a"))
    ).drop("around")

    part = lambda side, as_: frequent.select("lang", F.col("phrase").alias(side), F.col("n").alias(as_))
    cut = held.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", _joined(_words("phrase"), F.lit(1), F.col("k")).alias("first"),
                     _joined(_words("phrase"), F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    cut = cut.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    cut = cut.withColumn("a_wide", F.lit(SCALE).cast("decimal(38,0)") * F.col("a")).withColumn("lr", F.col("l").cast("decimal(38,0)") + F.col("r"))
    cut = cut.withColumn("score", F.expr("a_wide div lr"))
    weakest = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
    best = weakest.select("lang", "phrase", "a", "x.l", "x.r", "x.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(in_all, "lang").select(
        "lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", F.col("score").cast("long")
    )
