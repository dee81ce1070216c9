import random
import re
from collections import Counter

from dockside.llm import phrases
from tests.llm.cases import edge_documents, no_documents


def plain(rows, least, top=2000, covered=80):
    """The same list, phrase by phrase."""
    f = {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            own = f.setdefault(lang, Counter()) if w else {}
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    own[tuple(w[i:i + k])] += 1
    out = []
    for lang, own in f.items():
        n = sum(v for p, v in own.items() if len(p) == 1)
        cands = {p: v for p, v in own.items() if len(p) > 1 and v >= least}
        gone = {q for p, v in cands.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) for q in [p[i:i + k]] if 100 * v >= covered * own[q]}
        scored = []
        for p, a in cands.items():
            if p not in gone:
                s, k = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, r, p.decode(), -a, left, right, n, -s) for r, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def got(frame, **options):
    return sorted(tuple(r) for r in phrases.collocations(frame, **options).collect())


def frame_of(spark, rows):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, lang string, text string").repartition(3)


def random_rows(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "A", "b", "é", "of", "the", "x-y", "\x00", " ", "Ä"]
    run = "one two three four five six seven eight nine ten of the"  # a path many documents share
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ". ", "\n", " , "]) for _ in range(rng.randint(0, 60)))
    return [(rng.choice(["en", "de", None, "und"]), text() + (run if rng.random() < 0.5 else "") + rng.choice(["", "; "]) + text()) for _ in range(n)]


def test_against_plain_counts(spark, monkeypatch):
    rows = random_rows(1)
    frame = frame_of(spark, rows)
    assert got(frame, least=6) == plain(rows, 6)
    assert got(frame, least=2, top=7, covered=40) == plain(rows, 2, 7, 40)
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 100)  # chunks inside a text, stretches inside a path
    monkeypatch.setattr(phrases, "BUCKET_BYTES", 2_000)
    monkeypatch.setattr(phrases, "STRETCH", 2)
    assert got(frame, least=6) == plain(rows, 6)


def test_flow_gives_every_count(spark):
    rows = [("en", "a b c d e. a b c. a b; b c d e"), ("en", "a"), ("en", "c d e"), (None, "a b c d e f g")]
    counts = {(r.lang, r.phrase): r.n for r in phrases.phrase_counts(frame_of(spark, rows), least=1).collect()}
    assert counts["en", "a"] == 4 and counts["en", "a b"] == 3 and counts["en", "b c d"] == 2 and counts["en", "b c d e"] == 2
    assert counts["en", "d e"] == 3 and counts["en", "e"] == 3 and counts["en", "c d e"] == 3 and counts["und", "d e f g"] == 1
    assert ("en", "e a") not in counts


def test_paths_and_rings(spark):
    edges = ["a b c d", "b c d e", "c d e f", "x b c d", "r s t r", "s t r s", "t r s t", "q q q q"]
    frame = spark.createDataFrame([("en", p, 30 + k) for k, p in enumerate(edges)], "lang string, phrase string, n long")
    rows = {r.phrase: (r.path, r.place) for r in phrases.compact(frame).collect()}
    assert len(rows) == len(edges)
    assert rows["b c d e"] == ("c d e f", 1) and rows["c d e f"] == ("c d e f", 0)  # b c d has two edges in
    assert rows["a b c d"][0] == "a b c d" and rows["x b c d"][0] == "x b c d"
    assert all(rows[p] == (p, 0) for p in edges[4:])
    around = {r.phrase: r.around for r in phrases.heaviest_around(frame).collect()}
    want = Counter()
    for k, p in enumerate(edges):
        w = p.split()
        for q in {tuple(w[i:i + j]) for j in (2, 3) for i in range(5 - j)}:
            want[" ".join(q)] = max(want[" ".join(q)], 30 + k)
    assert around == dict(want)


def test_large_counts_stay_exact(spark, monkeypatch):
    """Products beyond 64 bits."""
    big = 1 << 60
    rows = [("en", w, len(w.split()), n) for w, n in [("a", big), ("b", big + 1), ("a b", big - 7)]]
    monkeypatch.setattr(phrases, "phrase_counts", lambda docs, least: spark.createDataFrame(rows, "lang string, phrase string, words int, n long"))
    (row,) = phrases.collocations(None).drop("n").collect()
    assert (row.a, row.l, row.r, row.score) == (big - 7, big, big + 1, 2_000_000 * (big - 7) // (2 * big + 1))


def test_edges(spark):
    docs = edge_documents(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert got(docs, least=3) == plain(rows, 3)
    assert got(no_documents(spark)) == []
    one = [("en", "word " * 50_000 + "end")] * 2  # one very long piece, repeated rows
    assert got(frame_of(spark, one)) == plain(one, 30)
