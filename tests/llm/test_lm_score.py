import math
from collections import Counter, defaultdict

import pytest

from dockside.llm import lm_score
from tests.llm.cases import edge_documents, no_documents


def plain_model(texts, weight=1.0):
    """P(c | a b) by the same smoothing, in plain dictionaries."""
    threes = Counter()
    for t in texts:
        b = b"\n\n" + t.encode()
        threes.update(b[k:k + 3] for k in range(len(b) - 2))
    counts = {k: v * weight for k, v in threes.items()}
    levels = []
    for n in (1, 2, 3):
        c = defaultdict(float)
        for k, v in counts.items():
            c[k[3 - n:]] += v
        levels.append(c)

    def p(gram):
        prob = 1 / 256
        for n, level in enumerate(levels, 1):
            g = gram[3 - n:]
            same = [v for k, v in level.items() if k[:-1] == g[:-1]]
            if same:
                prob = (level.get(g, 0) + len(same) * prob) / (sum(same) + len(same))
        return prob

    return p, sum(threes.values())


def test_against_a_plain_model(spark):
    docs = [(1, "the cat sat on the mat"), (2, "zzzz qqq été"), (3, "the dog\nsat"), (4, "the cat sat on the mat")]
    target = ["the cat sat", "a dog sat on a mat"]
    t, nt = plain_model(target)
    _, nb = plain_model([x for _, x in docs])
    b, _ = plain_model([x for _, x in docs], nt / nb)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in lm_score.cross_entropy_difference(frame, spark.createDataFrame([(x,) for x in target], "text string")).collect()}
    for i, text in docs:
        raw = b"\n\n" + text.encode()
        grams = [raw[k:k + 3] for k in range(len(raw) - 2)]
        lt, lb = (-sum(math.log(p(g)) for g in grams) / len(grams) for p in (t, b))
        assert got[i].n_tokens == len(grams)
        assert got[i].target_loss == pytest.approx(lt) and got[i].background_loss == pytest.approx(lb)
        assert got[i].score == pytest.approx(lt - lb)
    assert got[1].score < got[2].score


def test_edges(spark):
    docs = edge_documents(spark)
    rows = lm_score.cross_entropy_difference(docs, docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.score is None) == (r.n_tokens == 0)
        assert r.score is None or abs(r.score) < 1e-9  # the same corpus on both sides
    empty = no_documents(spark)
    assert lm_score.cross_entropy_difference(empty, docs).count() == 0
    alone = lm_score.cross_entropy_difference(docs, empty).where("n_tokens > 0").collect()
    assert all(r.target_loss == pytest.approx(math.log(256)) for r in alone)


def test_words_against_a_plain_model(spark):
    docs = [(1, "the cat sat, the cat ran"), (2, "zzzz été"), (3, "the dog\nsat"), (1, "the dog\nsat"), (4, " "), (None, None)]
    target = ["the cat sat", "a dog sat on a mat", None]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = lm_score.word_cross_entropy_difference(frame, spark.createDataFrame([(x,) for x in target], "text string")).collect()
    cut = lambda texts: Counter(w for t in texts if t for w in t.replace(",", " , ").split())
    counts = [cut(target), cut(t for _, t in docs)]
    scale = counts[0].total() / counts[1].total()

    def spelling(own, weight):
        threes = Counter()
        for w, n in own.items():
            b = b"\n\n" + w.encode() + b"\n"
            threes.update({b[k:k + 3]: 0 for k in range(len(b) - 2)})
            for k in range(len(b) - 2):
                threes[b[k:k + 3]] += n * weight
        return threes

    spelled = [spelling(counts[0], 1.0), spelling(counts[1], 1.0)]
    bytes_scale = sum(spelled[0].values()) / sum(spelled[1].values())
    spelled[1] = Counter({k: v * bytes_scale for k, v in spelled[1].items()})

    def byte_model(threes):
        def p(gram):
            prob = 1 / 256
            for n in (1, 2, 3):
                level = defaultdict(float)
                for k, v in threes.items():
                    level[k[3 - n:]] += v
                g = gram[3 - n:]
                same = [v for k, v in level.items() if k[:-1] == g[:-1]]
                if same:
                    prob = (level.get(g, 0) + len(same) * prob) / (sum(same) + len(same))
            return prob
        return p

    models = [byte_model(t) for t in spelled]

    def loss(side, w):
        b = b"\n\n" + w.encode() + b"\n"
        q = math.prod(models[side](b[k:k + 3]) for k in range(len(b) - 2))
        own, weight = counts[side], (1.0, scale)[side]
        return -math.log((own[w] * weight + len(own) * q) / (own.total() * weight + len(own)))

    want = []
    for i, text in docs:
        each = list(cut([text]).elements())
        means = [sum(loss(s, w) for w in each) / len(each) if each else None for s in (0, 1)]
        want.append((i or -1, len(each), means[0] or 0, means[1] or 0, means[0] - means[1] if each else 0))
    rows = sorted((r.doc_id or -1, r.n_tokens, r.target_loss or 0, r.background_loss or 0, r.score or 0) for r in got)
    assert len(rows) == len(want) and all(x == pytest.approx(y) for x, y in zip(rows, sorted(want)))
    assert all((r.score is None) == (r.n_tokens == 0) for r in got)


def test_words_tell_content_that_spelling_does_not(spark):
    # Words of the same letter trigrams' frequency: every word is three syllables of one set, the topics differ in which.
    parts = ["ba", "ke", "lo", "mi", "nu"]
    every = [a + b + c for a in parts for b in parts for c in parts]
    topics = [every[k::2] for k in (0, 1)]
    text = lambda topic, k: " ".join(topics[topic][(k * 7 + j * 11) % len(topics[topic])] for j in range(40))
    docs = spark.createDataFrame([(k, text(k % 2, k)) for k in range(60)], "doc_id long, text string")
    target = spark.createDataFrame([(text(0, k),) for k in range(100, 130)], "text string")
    scores = {r.doc_id: r.score for r in lm_score.word_cross_entropy_difference(docs, target).collect()}
    near, far = ([scores[k] for k in range(60) if k % 2 == t] for t in (0, 1))
    assert min(far) - max(near) > 1


def test_words_edges(spark):
    docs = edge_documents(spark)
    rows = lm_score.word_cross_entropy_difference(docs, docs).collect()
    assert sorted(r.doc_id or -1 for r in rows) == sorted(r.doc_id or -1 for r in docs.collect())
    assert all(r.score is None if r.n_tokens == 0 else abs(r.score) < 1e-9 for r in rows)
    empty = no_documents(spark)
    assert lm_score.word_cross_entropy_difference(empty, docs).count() == 0
    alone = lm_score.word_cross_entropy_difference(docs, empty).where("n_tokens > 0").collect()
    assert all(r.target_loss > math.log(256) for r in alone)
