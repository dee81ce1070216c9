import re
import time
import zlib

import numpy as np
import pytest

from dockside.llm import toxicity
from dockside.llm.labelled import training_rows
from dockside.llm.queries import op1_toxicity
from tests.llm.cases import edge_documents, label_rows, no_documents

LARGER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in op1_toxicity(spark, LARGER).collect()}
    known = [r for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all(rows[r.doc_id].held_out for r in known) and all(0 <= r.score <= 1 for r in rows.values())
    toxic = [rows[r.doc_id].predicted for r in known if r.toxic]
    clean = [rows[r.doc_id].predicted for r in known if not r.toxic]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.02


def test_features():
    lexicon = toxicity.Lexicon({"idiot$": 4.0, "blarg": 3.0})
    names = toxicity.FEATURES
    of = lambda text: dict(zip(names, toxicity.features(text, lexicon)))
    assert all(v == 0 for v in of("").values())
    a = of("You are an idiot and a blargenheim! YES NO WHY")
    assert a["max_weight"] == 4 and np.expm1(a["log_hits"]) == pytest.approx(2) and a["near_you_density"] > 0
    assert a["shouted_share"] > 0 and a["exclamations"] > 0 and of("idiots")["log_hits"] == 0
    assert of("an 1di0t or !d!ot")["masked_density"] > 0 and of("an id1ot")["log_masked_hits"] > 0
    assert of("i d i o t")["log_masked_hits"] > 0 and of("idioooot")["stretched_density"] > 0
    assert of("idioot nothing")["log_masked_hits"] == 0 and of("idiooot")["log_masked_hits"] == pytest.approx(np.log(2))


def test_lexicon_has_words_and_beginnings(spark):
    rng = np.random.default_rng(0)
    filler = lambda: " ".join(rng.choice(["the", "of", "stone", "river"], 20))
    rows = [(filler() + " moron", 1.0) for _ in range(20)] + [(filler() + f" blarg{k}x".replace(str(k), chr(97 + k)), 1.0) for k in range(20)]
    rows += [(filler(), 0.0) for _ in range(400)]
    lexicon = toxicity.draw_lexicon(spark.createDataFrame(rows, "text string, label double"))
    assert lexicon.weight("moron") > 3 and lexicon.weight("blargzz") > 3 and lexicon.weight("river") == 0


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (10, 0, None), (None, 0, 1)], [(1, 1, 0), (1, 0, 1), (8, 0, 0), (3, 1, 1), (5, 0, 0)]])
def test_edges(spark, labels):
    docs = edge_documents(spark)
    rows = toxicity.classify(docs, label_rows(spark, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert toxicity.classify(no_documents(spark), label_rows(spark, labels)).count() == 0


def test_long_words_take_linear_time():
    lexicon = toxicity.Lexicon({"idiot$": 4.0})
    start = time.perf_counter()
    for text in ("a" * 1_000_000, "x1" * 400_000, "é" * 500_000 + "1", "a.b " * 200_000, "a_b" * 200_000):
        assert len(toxicity.features(text, lexicon)) == len(toxicity.FEATURES)
    assert time.perf_counter() - start < 30


def test_masked_words_as_by_every_start():
    rng = np.random.default_rng(1)
    every_start = re.compile(r"[^\W\d_]+(?:[0-9@$*!|]+[^\W\d_]+)+")
    for _ in range(3000):
        text = "".join(rng.choice(list("abé1@_! -"), rng.integers(1, 25)))
        assert toxicity._MASKED.findall(text) == every_start.findall(text)


def test_sample_is_bounded_in_rows(spark):
    docs = spark.range(3000).selectExpr("id % 3 as doc_id", "concat('text ', id) as text")
    labels = label_rows(spark, [(0, 1, 0), (1, 0, 1), (2, 1, 1)])
    sample = lambda: sorted(training_rows(docs.repartition(4), labels, "toxic", folds=5, fold=0, max_rows=2).collect())
    assert len({r.doc_id for r in sample()}) == len(sample()) <= 2 and sample() == sample()
