import os
from collections import Counter

import numpy as np
import pytest

from dockside.llm import sharding
from tests.llm.cases import edge_documents, no_documents


def plain_table(shards, size):
    """Whole preference lists, and shards taking turns down them."""
    lists = {}
    for s in sorted(shards):
        offset, skip = sharding._digest(s, "offset") % size, sharding._digest(s, "skip") % (size - 1) + 1
        lists[s] = iter([(offset + j * skip) % size for j in range(size)])
    table = [None] * size
    while None in table:
        for s in sorted(shards):
            if None in table:
                table[next(x for x in lists[s] if table[x] is None)] = s
    return table


def test_table_against_preference_lists():
    for names, size in ((["a", "b", "c"], 13), (["x"], 2), (sharding.shard_names(7), 101)):
        assert [names[k] for k in sharding.lookup_table(names, size)] == plain_table(names, size)


def test_balance_and_small_changes():
    names = sharding.shard_names(64)
    table = sharding.lookup_table(names)
    counts = Counter(table.tolist())
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.lookup_table(names[:-1])
    stayed = table != 63
    assert (np.array(names)[table[stayed]] == np.array(names)[fewer[stayed]]).mean() > 0.9
    shuffled = names[::-1]
    assert [shuffled[k] for k in sharding.lookup_table(shuffled)] == [names[k] for k in table]


@pytest.mark.parametrize("names, size", [([], 13), (["a", "a"], 13), (["a"], 12), (["a", "b", "c"], 2)])
def test_bad_tables(names, size):
    with pytest.raises(ValueError):
        sharding.lookup_table(names, size)


def test_place_and_write(spark, tmp_path):
    docs = edge_documents(spark)
    names = sharding.shard_names(4)
    placed = sharding.place(docs, names, size=101)
    assert placed.count() == docs.count() and set(docs.columns) <= set(placed.columns)
    of_id = {}
    table = plain_table(names, 101)
    for r in placed.collect():
        assert r.shard == table[r.slot] and of_id.setdefault(r.doc_id, r.shard) == r.shard
    path = os.path.join(tmp_path, "shards")
    sharding.write_shards(docs, path, names, size=101)
    back = spark.read.parquet(path)
    assert back.count() == docs.count()
    assert {(r.doc_id, r.shard) for r in back.select("doc_id", "shard").collect()} == set(of_id.items())
    assert sharding.place(no_documents(spark), names).count() == 0
