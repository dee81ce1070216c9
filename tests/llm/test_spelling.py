import random
import re
import zlib
from collections import Counter

import pytest

from dockside.llm import spelling
from tests.llm.cases import edge_documents, no_documents


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_vocabulary(rows):
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def plain_variants(v):
    out = {}
    for w, n in v.items():
        near = [x for x in v if one_edit(w, x)]
        best = min(near, key=lambda x: (-v[x], x), default=None)
        held = best is not None and v[best] >= 5 * n
        out[w] = (best if held else None, n, len(near), v[best] if held else None)
    root = lambda w: w if out[w][0] is None else root(out[w][0])
    return sorted((w, f or "", root(w), n, k, m or 0) for w, (f, n, k, m) in out.items())


def got(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


def words(rng, n):
    """Dense: few letters, lengths around the least, some beyond the first plane and some upper-case letters kept."""
    return sorted({"".join(rng.choice("aabbcéÀ") for _ in range(rng.randint(6, 9))) for _ in range(n)} | {"z" * 40, "z" * 41, "abcdef" * 30})


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_every_pair_once(seed):
    rng = random.Random(seed)
    indexed, asked = words(rng, 250), words(rng, 250) + ["qqqqqq", "abc\U0001f600abc"]
    q, f = spelling.WordIndex(indexed).near(asked, indexed)
    pairs = list(zip(q.tolist(), f.tolist()))
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(i, j) for i, a in enumerate(asked) for j, b in enumerate(indexed) if one_edit(a, b)}


def test_index_of_one_word_and_of_repeated_words():
    assert [x.tolist() for x in spelling.WordIndex(["abcdef"]).near(["abcdeg", "abcdef", "bcdefg"], ["abcdef"])] == [[0], [0]]
    with pytest.raises(ValueError):
        spelling.WordIndex(["abcdef", "abcdef"]).near(["abcdef"], ["abcdef", "abcdef"])


@pytest.mark.parametrize("block", [spelling.BLOCK, 400])  # the small one deals the words of one beginning over several blocks
def test_against_plain_pairs(spark, block):
    rng = random.Random(7)
    some = words(rng, 200)
    rows = [(k if k % 9 else None, " ".join(rng.choices(some, weights=[1 + (i % 13) ** 3 for i in range(len(some))], k=150)) + ", " + some[k % len(some)].upper()) for k in range(60)]
    rows.append((99, " ".join(w for w, n in [("chaina", 200), ("chainb", 36), ("choinb", 6)] for _ in range(n))))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    v = plain_vocabulary(rows)
    have = got(spelling.variants(frame, block=block))
    assert len(v) > 100 and have == plain_variants(v)
    assert any(f and r != f for _, f, r, *_ in have)  # a chain of forms


def test_parts_of_one_beginning_that_share_a_block(spark):
    """Words of one beginning fill many parts, more than there are blocks: some lie together, and a near word still counts once."""
    rng = random.Random(11)
    some = sorted({"abc" + "".join(rng.choice("abc") for _ in range(rng.randint(4, 6))) for _ in range(300)})
    v = {w: 5 + k % 40 for k, w in enumerate(some)}
    vocab = spark.createDataFrame(list(v.items()), "word string, n long")
    have = {r.word: (r.n_near, r.form, r.form_n) for r in spelling.near_words(vocab, block=200).collect()}
    near = {w: [x for x in v if one_edit(w, x)] for w in v}
    best = {w: min(xs, key=lambda x: (-v[x], x)) for w, xs in near.items() if xs}
    assert have == {w: (len(near[w]), b, v[b]) for w, b in best.items()}


def test_edges(spark):
    docs = edge_documents(spark)
    assert got(spelling.variants(docs)) == plain_variants(plain_vocabulary([(r.doc_id, r.text) for r in docs.collect()]))
    assert spelling.variants(no_documents(spark)).count() == 0
    long = ["x" * 5_000, "x" * 4_999 + "y", "short words here"]
    frame = spark.createDataFrame([(k, t) for t in long for k in range(6)], "doc_id long, text string")
    assert got(spelling.variants(frame)) == plain_variants(plain_vocabulary([(k, t) for t in long for k in range(6)]))
