import zlib

import numpy as np
import pytest

from dockside.llm import quality
from dockside.llm.queries import op3_quality
from tests.llm.cases import edge_documents, label_rows, no_documents

SMALL = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in op3_quality(spark, SMALL).collect()}
    known = [r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(rows[r.doc_id].held_out for r in known) and all(0 <= r.score <= 1 for r in rows.values())
    right = [rows[r.doc_id].predicted == r.quality for r in known]
    good = [rows[r.doc_id].predicted for r in known if r.quality]
    assert np.mean(right) > 0.93 and np.mean(good) > 0.97


def test_held_out_labels_are_not_read(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    flipped = labels.selectExpr(
        "doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - quality else quality end as quality", "toxic"
    )
    score = lambda lab: {r.doc_id: r.score for r in quality.classify(docs, lab, max_rows=200).collect()}
    assert score(labels) == score(flipped)


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(40, 3)), np.where(rng.random(40) < 0.5, 1.0, -1.0)
    rows = [np.arange(3)] * 40
    w, b = quality.dual_coordinate_descent(rows, list(x), y, np.full(40, 0.5), 3000)
    value = lambda v: (v @ v) / 2 + 0.5 * np.maximum(0, 1 - y * (x @ v[:3] + v[3])).sum()
    best = np.append(w[:3], b)
    assert all(value(best) <= value(best + rng.normal(size=4) * s) + 1e-3 for s in (0.01, 0.1, 1) for _ in range(200))


def test_log_count_ratio_of_indicators():
    ratio = quality.log_count_ratios([np.array([1, 2]), np.array([2])], np.array([1, 0]))
    assert ratio[1] > 0 > ratio[2]


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (10, None, 0), (None, 0, 0)], [(1, 1, 0), (1, 0, 0), (8, 0, 0), (3, 1, 1), (5, 0, 0)]])
def test_edges(spark, labels):
    docs = edge_documents(spark)
    rows = quality.classify(docs, label_rows(spark, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    kept = quality.keep_good(docs, label_rows(spark, labels))
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in rows)
    assert quality.classify(no_documents(spark), label_rows(spark, labels)).count() == 0


def test_classes_of_long_words_are_counted_whole():
    for word in (b"a" * 9000, b"A" * 5000 + b"b" * 4999, b"1" * 4096, b"ab#9" * 3):
        raw = b" x\t" + word + b"\n Yy "
        b = np.frombuffer(raw, np.uint8)
        starts = np.array([raw.index(w) for w in raw.split()])
        got = np.array(quality._class_counts(b, starts, max(map(len, raw.split()))))
        want = [[sum(quality._CLASS[c] == k for c in w) for w in raw.split()] for k in range(5)]
        assert (got == np.array(want)).all()
