import re
from collections import Counter

import numpy as np

from dockside.llm import weak_rules
from dockside.llm.queries import op5_quality_rules
from tests.llm.cases import edge_documents, no_documents

SMALL = "/root/testdata/sf0.01"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines, dup = [], 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.append(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_base_figures(spark):
    for docs in (edge_documents(spark), spark.read.parquet("/root/testdata/sf0.001/documents.parquet")):
        rows = weak_rules.judge(docs).collect()
        got = sorted(map(str, ((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)))
        assert got == sorted(map(str, ((r.doc_id, *plain(r.text)) for r in docs.collect())))
        assert not any(r.kept and r.base_failed for r in rows) and all(0 <= r.probability <= 1 for r in rows)


def test_agrees_with_labels(spark):
    rows = {r.doc_id: r for r in op5_quality_rules(spark, SMALL).collect()}
    known = [(rows[r.doc_id], r.quality) for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()]
    good = [r.kept for r, q in known if q and not r.base_failed]
    bad = [r.kept for r, q in known if not q]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.05


def test_expectation_maximisation_finds_the_rates():
    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.85
    alarm = np.array([0.01, 0.005, 0.002, 0.01])
    caught = np.array([0.7, 0.5, 0.6, 0.4])
    against = rng.random((20_000, 4)) < np.where(good[:, None], alarm, caught)
    votes = np.where(against, -1, 0)
    kinds, at, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = weak_rules.expectation_maximisation(kinds, n.astype(float), max_false_alarm=0.05)
    assert abs(model.prior - 0.85) < 0.02
    assert np.abs(model.on_good[:, 0] - alarm).max() < 0.01 and np.abs(model.on_bad[:, 0] - caught).max() < 0.05
    kept = model.posterior(kinds)[at.ravel()] >= 0.5
    assert (kept == good).mean() > 0.97


def test_one_vote_does_not_sink_a_document():
    votes = np.array([[1, 0, 0], [1, 0, -1], [-1, -1, -1], [0, -1, -1]])
    model = weak_rules.expectation_maximisation(votes, np.array([900.0, 30, 40, 30]), max_false_alarm=0.1)
    p = model.posterior(votes)
    assert p[0] > p[1] > 0.5 > p[3] > p[2]


def test_no_documents(spark):
    assert weak_rules.judge(no_documents(spark)).count() == 0


def test_vocabulary_votes_at_every_length():
    rng = np.random.default_rng(3)
    vocabulary = next(k for k, r in enumerate(weak_rules.RULES) if r.name == "vocabulary")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines", "distinct", "letters", "upper", "lower", "ends", "wordless"]
    for n in (1999, 2000, 2001, 5000, 100_000):
        poor, rich = (" ".join(map(str, rng.integers(0, k, n))) for k in (60, 4000))
        rows = weak_rules.pd.DataFrame([weak_rules.measure(t) for t in (poor, rich)], columns=names, dtype="int64")
        votes = weak_rules.RULES[vocabulary].votes(weak_rules.figures(rows)["distinct_share"].to_numpy())
        assert list(votes) == [-1, 0]
    assert weak_rules.distinct_words([]) == 0 and weak_rules.distinct_words([b"a", b"b", b"a"], 2) == 3
