import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from dockside.llm import packing
from tests.llm.cases import edge_documents, no_documents

SMALL = "/root/testdata/sf0.001"


def whole_text_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check_sequences(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("source", ["edge", "sample"])
def test_pieces_are_those_of_the_whole_text(spark, source):
    docs = edge_documents(spark) if source == "edge" else spark.read.parquet(f"{SMALL}/documents.parquet")
    tok = packing.WordTokenizer(packing.default_tokenizer()).tokenizer
    expected = []
    for r in docs.select("doc_id", "text").collect():
        ids = whole_text_ids(tok, r.text)
        for k, s in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[s:s + 4096], "<u4")
            expected.append((r.doc_id, k, s, len(part), zlib.crc32(part.tobytes())))
    rows = packing.pack_documents(docs).collect()
    key = lambda t: (t[0] is None, t)
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=lambda t: (t[0] or -1, t[1:])) == sorted(expected, key=lambda t: (t[0] or -1, t[1:]))
    used = check_sequences(rows, 4096)
    lower = packing.lower_bound(np.array([r.length for r in rows]), 4096)
    assert lower <= used <= lower + 1


def test_words_in_any_case_and_script():
    tok = packing.WordTokenizer(packing.default_tokenizer(), cached_words=50)
    own = Tokenizer.from_file(packing.default_tokenizer())  # unaltered
    assert tok.ids("hello <|endoftext|> world").tolist() == own.encode("hello <|endoftext|> world", add_special_tokens=False).ids
    assert tok.ids("a<|endoftext|>b <|startoftext|>").tolist() == own.encode("a<|endoftext|>b <|startoftext|>", add_special_tokens=False).ids
    rng = random.Random(3)
    pieces = ["It's", "don't,", "ÉTÉ.", "straße", "Å", "H̱", "K", "x_y", "3.14", "<|endoftext|>", "!!!", "…", "日本語", "we'll", "THE.", "l'été", "İ"]
    for _ in range(200):
        text = rng.choice([" ", "\n", " ", "\t "]).join(rng.choices(pieces, k=rng.randint(0, 12)))
        assert tok.ids(text).tolist() == own.encode(text, add_special_tokens=False).ids


def test_bounds_and_best_fit():
    rng = np.random.default_rng(1)
    for _ in range(50):
        lengths = np.sort(rng.integers(1, 101, rng.integers(1, 60)))[::-1]
        bins = packing.best_fit_decreasing(lengths, 100)
        fill = np.bincount(bins, weights=lengths)
        assert fill.max() <= 100
        assert packing.lower_bound(lengths, 100) <= len(fill)
    assert packing.lower_bound(np.array([51] * 9), 100) == 9  # more than the sum tells
    assert packing.lower_bound(np.array([34] * 9), 100) == 5  # two to a bin
    assert packing.lower_bound(np.array([], int), 100) == 0


def test_partitions_with_gaps_exchange(spark):
    rng = np.random.default_rng(2)
    items = spark.createDataFrame(
        [(int(k), 0, 0, int(n), 7) for k, n in enumerate(rng.integers(1, 101, 3000))], "doc_id long, piece int, start long, length long, ids_crc32 long"
    )
    rows = packing.pack(items, capacity=100, partition_pieces=300).collect()
    assert sorted(r.doc_id for r in rows) == list(range(3000))
    used = check_sequences(rows, 100)
    lengths = np.array([r.length for r in rows])
    assert packing.lower_bound(lengths, 100) <= used <= 1.03 * packing.lower_bound(lengths, 100)


def test_an_exchange_adds_no_bin(spark):
    rows = [(k % 7, k, 0, 0, n, 7, k // 2) for k, n in enumerate([60, 40, 70, 20, 55, 30, 90, 5, 50, 45] * 20)]
    before = spark.createDataFrame(rows, "part long, doc_id long, piece int, start long, length long, ids_crc32 long, before long")
    by_bin = before.selectExpr("before % 7 as part", "doc_id", "piece", "start", "length", "ids_crc32", "before")
    after = packing._pack_partitions(by_bin, 100, False).collect()
    assert len({(r.part, r.bin) for r in after}) <= 100 and sum(r.length for r in after) == sum(r[4] for r in rows)
    for r in after:
        assert r.settled or sum(x.length for x in after if (x.part, x.bin) == (r.part, r.bin)) < 100


def test_sequences_hold_the_ids(spark):
    docs = edge_documents(spark).where("doc_id <> 5 or doc_id is null")
    placed = packing.pack_documents(docs)
    tok = packing.WordTokenizer(packing.default_tokenizer()).tokenizer
    got = sorted(i for r in packing.sequences(docs, placed).collect() for i in r.ids)
    assert got == sorted(i for r in docs.collect() for i in whole_text_ids(tok, r.text))


def test_no_documents(spark):
    assert packing.pack_documents(no_documents(spark)).count() == 0
