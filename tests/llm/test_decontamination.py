import random

import numpy as np

from dockside.llm import decontaminate
from tests.llm.cases import edge_documents, no_documents


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_least_edits_against_all_stretches():
    rng = random.Random(0)
    for _ in range(60):
        item, text = [rng.randint(1, 4) for _ in range(rng.randint(1, 6))], [rng.randint(1, 4) for _ in range(rng.randint(0, 9))]
        best = min(plain_distance(item, text[s:e]) for s in range(len(text) + 1) for e in range(s, len(text) + 1))
        edits, start, end = decontaminate.least_edits(np.array(item), np.array(text, np.int64))
        assert edits == best == plain_distance(item, text[start:end])


def made(rng, n):
    return [rng.choice("abcdefghijklmnop") + rng.choice("aeiou") + rng.choice("lmnrst") for _ in range(n)]


def test_finds_edited_passages_and_leaves_others(spark):
    rng = random.Random(1)
    items = [(k, " ".join(made(rng, rng.randint(12, 60)))) for k in range(40)]
    docs, wanted, too_far = [], set(), set()
    for k in range(400):
        i, text = rng.choice(items)
        words, n = text.split(), len(text.split())
        d = int(n * 0.2) if k % 2 else 0
        if k % 5 == 4:  # more than the limit, even if some edits cancel
            words = [w if j % 2 else "zzz" for j, w in enumerate(words)]
            too_far.add((k, i))
        else:
            for _ in range(d):
                p = rng.randrange(len(words))
                words[p:p + rng.randint(0, 1)] = rng.choice([[], made(rng, 1)])
            wanted.add((k, i))
        docs.append((k, " ".join(made(rng, rng.randint(0, 300)) + words + made(rng, rng.randint(0, 300)))))
    found = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert len(got & wanted) >= 0.97 * len(wanted) and not got & too_far and got <= wanted
    texts, by_item = dict(docs), dict(items)
    for r in found[:50]:
        stretch = texts[r.doc_id].split()[r.start_word:r.end_word]
        assert plain_distance(by_item[r.item_id].split(), stretch) == r.edits <= 0.2 * len(by_item[r.item_id].split())


def test_blocks_of_items_and_case(spark):
    rng = random.Random(2)
    items = [(k, " ".join(made(rng, 20))) for k in range(9)]
    docs = spark.createDataFrame([(k, f"x, {t.upper()}! y") for k, t in items] + [(99, "nothing of it")], "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.edits) for r in decontaminate.contamination(docs, table, block_items=3).collect()}
    assert got == {(k, k, 0) for k in range(9)}
    assert [r.doc_id for r in decontaminate.drop_contaminated(docs, table, block_items=3).collect()] == [99]


def test_edges(spark):
    docs = edge_documents(spark)
    items = spark.createDataFrame([(1, None), (2, ""), (3, "the fox"), (4, "It barks at you, and the FOX runs off"), (None, "a b c d e f g")], "item_id long, text string")
    got = decontaminate.contamination(docs, items).collect()
    assert sorted((r.doc_id or -1, r.item_id) for r in got) == [(-1, 4), (1, 4), (1, 4), (10, 4)]
    clean = decontaminate.drop_contaminated(docs, items)
    assert clean.columns == docs.columns and clean.count() == docs.count() - 4
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, none).count() == 0
    assert decontaminate.drop_contaminated(docs, none).count() == docs.count()
    assert decontaminate.contamination(no_documents(spark), items).count() == 0


def edited(rng, words, d):
    words = list(words)
    for _ in range(d):
        p = rng.randrange(len(words))
        words[p:p + rng.randint(0, 1)] = rng.choice([[], made(rng, 1)])
    return words


def test_every_length_of_a_mixed_benchmark_is_found():
    rng = random.Random(3)
    items = [(k, made(rng, 12)) for k in range(80)] + [(100 + k, made(rng, n)) for k, n in enumerate([60, 120, 250, 500] * 3)]
    index = decontaminate.ItemIndex([(k, " ".join(w)) for k, w in items])
    for n in (12, 60, 120, 250, 500):
        of = [x for x in items if len(x[1]) == n]
        wanted, texts = [], []
        for j in range(60):
            k, w = of[j % len(of)]
            wanted.append((j, k))
            texts.append([x.encode() for x in made(rng, 40) + edited(rng, w, int(n * 0.2)) + made(rng, 40)])
        got = {(t, k): (e, s, z) for t, k, e, s, z in index.matches(texts)}
        share = sum(x in got for x in wanted) / len(wanted)
        assert share >= 0.9 if n == 12 else share == 1, (n, share)  # the walks' target is 0.97; the rest is exact
        assert all(got[x][0] <= n * 0.2 for x in wanted if x in got)


def test_exact_search_finds_all_that_brute_force_finds(monkeypatch):
    monkeypatch.setattr(decontaminate, "WALK_WORDS", 0)
    monkeypatch.setattr(decontaminate, "_HELD_PAIRS", 7)  # many small parts
    rng = random.Random(4)
    few = [f"w{k}" for k in range(9)]
    items = [(k, [rng.choice(few) for _ in range(rng.randint(5, 24))]) for k in range(25)]
    texts = [[rng.choice(few) for _ in range(rng.randint(0, 12))] + edited(rng, rng.choice(items)[1], rng.randint(0, 5)) for _ in range(60)]
    index = decontaminate.ItemIndex([(k, " ".join(w)) for k, w in items])
    got = {(t, k): (e, s, z) for t, k, e, s, z in index.matches([[x.encode() for x in t] for t in texts])}
    want = {}
    code = {w.encode(): c for w, c in zip(few, range(1, 99))}
    for t, text in enumerate(texts):
        for k, w in items:
            best = decontaminate.least_edits(np.array([code[x.encode()] for x in w]), np.array([code.get(x.encode(), 0) for x in text], np.int64))
            if best[0] <= decontaminate.allowed(len(w)):
                want[t, k] = best
    assert got == want and len(want) > 40
