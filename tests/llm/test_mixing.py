import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockside.llm import mixing
from tests.llm.cases import edge_documents, no_documents


def plain_targets(sizes):
    """Excess reshared by weight until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in fixed]
        left, w = total - sum(fixed.values()), sum(weight[s] for s in open_)
        shares = {s: left * weight[s] / w for s in open_}
        over = [s for s in open_ if shares[s] > 3 * sizes[s]]
        if not over:
            return fixed | shares
        fixed |= {s: 3 * sizes[s] for s in over}


def documents(spark, seed=3, n=900):
    rng = random.Random(seed)
    names = ["b", "a", None, "é", "Z", "small", "tiny"]
    rows = [(k, rng.choices(names, weights=[40, 10, 8, 8, 8, 1, 1])[0], "w " * rng.choice([0, 1, 5, 30, 80, 200])) for k in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)


def test_targets(spark):
    rows, _ = documents(spark)
    sizes = Counter()
    for _, s, t in rows:
        sizes[s] += len(t.split())
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    have = {r.source: r.target for r in mixing.targets(frame).collect()}
    want = plain_targets(sizes)
    assert have.keys() == want.keys() and all(have[s] == pytest.approx(want[s]) for s in want)
    assert sum(have.values()) == pytest.approx(sum(sizes.values()))
    assert any(have[s] == 3 * sizes[s] for s in have)


@pytest.mark.parametrize("block_words", [mixing.BLOCK_WORDS, 300])
def test_shares_meet_targets(spark, block_words):
    rows, frame = documents(spark)
    have = mixing.shares(frame, block_words=block_words).collect()
    source = {i: s for i, s, _ in rows}
    assert sorted(r.doc_id for r in have) == sorted(source)
    taken, aim = Counter(), {}
    for r in have:
        assert r.size == len(rows[r.doc_id][2].split()) and r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[source[r.doc_id]] += r.taken
        aim[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - aim[s]) <= 200 for s in aim)
    again = mixing.shares(frame.repartition(7), block_words=block_words).collect()
    assert sorted(have) == sorted(again)


def test_every_pass_is_whole_before_the_next(spark):
    """Documents of one source are taken as often as each other, or once more."""
    rows, frame = documents(spark)
    per = defaultdict(set)
    for r in mixing.plan(frame, block_words=300).where("size > 0").collect():
        per[r.source].add(len(r.shards))
    assert all(max(v) - min(v) <= 1 for v in per.values())


def test_tree_deals_out_exact_quotas(spark):
    quotas = {"a": 1000, "b": 37, None: 1, "c": 0, "d": 410}
    frame = spark.createDataFrame(list(quotas.items()), "source string, n long")
    rows = mixing.tree(frame, 16).collect()
    for s, n in quotas.items():
        assert sum(r.n for r in rows if r.source == s) == n
    loads = Counter()
    for r in rows:
        loads[r.shard] += r.n
    assert set(loads) == set(range(16)) and max(loads.values()) - min(loads.values()) <= 1
    assert len({r.n for r in rows if r.source == "a"}) > 3  # drawn, not cut evenly


def test_split_is_hypergeometric():
    q = np.array([30, 10, 60])
    draws = np.array([mixing.split(q, 40, np.random.default_rng(k)) for k in range(4000)])
    assert (draws.sum(axis=1) == 40).all() and (draws <= q).all()
    assert draws.mean(axis=0) == pytest.approx([12, 4, 24], abs=0.2)
    want = [40 * p * (1 - p) * 60 / 99 for p in (0.3, 0.1, 0.6)]
    assert draws.var(axis=0) == pytest.approx(want, rel=0.1)
    big = mixing.split(np.array([3 * 10**9, 10**9]), 2 * 10**9, np.random.default_rng(1))
    assert big.sum() == 2 * 10**9 and abs(big[0] - 1.5e9) < 1e6


def test_mixture_repeats_and_shards(spark, tmp_path):
    rows, frame = documents(spark, n=300)
    extra = frame.withColumn("shard", F.lit("own"))
    mixed = mixing.mixture(extra, block_words=200)
    shard = mixed.columns[-2]
    assert mixed.columns[:4] == extra.columns and shard == "_shard"
    times = Counter(r.doc_id for r in mixed.collect())
    want = {r.doc_id: len(r.shards) for r in mixing.plan(frame, block_words=200).collect()}
    assert all(times[i] == want[i] for i in want)
    mixing.write_mixture(frame, str(tmp_path / "mix"), block_words=200)
    assert spark.read.parquet(str(tmp_path / "mix")).count() == sum(times.values())


def test_edges(spark):
    docs = edge_documents(spark)
    have = mixing.shares(docs).collect()
    assert sorted((r.doc_id or -1, r.size) for r in have) == sorted((r.doc_id or -1, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in docs.collect())
    assert all(r.taken <= 3 * r.size for r in have)
    assert mixing.shares(no_documents(spark)).count() == 0
    silent = spark.createDataFrame([(1, None, None), (2, "a", ""), (None, "a", " ")], "doc_id long, source string, text string")
    assert [(r.taken, r.target) for r in mixing.shares(silent).collect()] == [(0, 0.0)] * 3
    assert mixing.mixture(docs).count() >= 0
