import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from dockside.llm import simhash
from dockside.llm.components import components
from tests.llm.cases import edge_documents, no_documents

SMALL = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, x in enumerate(ids):
        least[find(i)].append(x)
    smallest = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return [smallest[find(i)] for i in range(len(fps))]


@pytest.mark.parametrize("source", ["edge", "sample"])
def test_against_all_pairs(spark, source):
    docs = edge_documents(spark) if source == "edge" else spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    expected = zip([r.doc_id for r in rows], fps, plain_components([r.doc_id for r in rows], fps))
    got = simhash.cluster(docs)
    got = got.select("doc_id", simhash.hex_digits(got.fp).alias("f"), "component_id").collect()
    text = lambda x: sorted(map(str, x))
    assert text((r.doc_id, r.f, r.component_id) for r in got) == text((i, f"{f:016x}", c) for i, f, c in expected)


@pytest.mark.parametrize("max_run", [20_000, 5])
def test_dense_groups_and_cut_runs(spark, max_run):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [b ^ (np.uint64(1) << np.uint64(k)) for b in base[:4] for k in range(0, 63, 2)]
    far = [base[5] ^ np.uint64(0b11110 << s) for s in range(0, 50, 3)]
    fps = np.unique(np.concatenate([base, near, far]))
    ids = list(range(len(fps)))
    prints = spark.createDataFrame([(k, int(f)) for k, f in zip(ids, fps.view(np.int64))], "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.class_components(prints, max_run=max_run).collect()}
    assert [got[int(f)] for f in fps.view(np.int64)] == plain_components(ids, [int(f) for f in fps])


def test_blocks_lose_no_pair():
    masks = simhash.block_masks()
    rng = np.random.default_rng(4)
    for _ in range(2000):
        flip = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(flip & m == 0 for m in masks)
    assert len(masks) == 35


def test_long_paths_become_one_component(spark):
    edges = [(k, k + 1) for k in range(0, 300)] + [(1000, 1001), (1001, 1001)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(301), 0), 1000: 1000, 1001: 1000}


def test_keep_one(spark):
    docs = edge_documents(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    found = sorted((r.doc_id, r.text or "") for r in kept.where("doc_id is not null").select("doc_id", "text").collect())
    # 1 stays once, and its other text; 2 stands for all empty texts, those without a number too.
    assert [i for i, _ in found] == [1, 1, 2, 5, 6, 7, 8, 9]
    assert kept.where("doc_id is null").count() == 0
    nameless = spark.createDataFrame([(None, "one two three"), (None, "one two three"), (None, "four five")], "doc_id long, text string")
    assert sorted(r.text for r in simhash.keep_one(nameless).collect()) == ["four five", "one two three"]


def test_no_documents(spark):
    assert simhash.cluster(no_documents(spark)).count() == 0
    assert simhash.keep_one(no_documents(spark)).count() == 0
