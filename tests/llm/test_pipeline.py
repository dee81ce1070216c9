import numpy as np

import corpus_pipeline
from dockside.llm import decontaminate, packing, quality, secrets, simhash
from tests.llm.cases import edge_documents, label_rows, no_documents
from tests.llm.test_packing import check_sequences, whole_text_ids
from tests.llm.test_secrets import plain_spans
from tests.llm.test_simhash import plain_components, plain_fingerprint

SMALL = "/root/testdata/sf0.001"


def masked(text):
    spans = [(s, e) for s, _, e, _ in plain_spans(text)]
    out, at = "", 0
    for s, e in spans:
        if s > at or not out:
            out += text[at:s] + secrets.REDACTED
        at = max(at, e)
    return out + text[at:] if spans else text


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    table = lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet")
    steps, seen = [f for _, f in corpus_pipeline.STAGES], {}
    for k, step in enumerate(steps[:-1]):
        out = step(spark, docs, SMALL)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen[k] = (docs.collect(), out.collect())
        docs = spark.createDataFrame(seen[k][1], docs.schema)
    model = quality.train(table("documents"), table("labels"))
    buckets = np.zeros(1 << quality.BUCKET_BITS, bool)
    before, after = seen[0]
    good = {r.doc_id for r in before if model.score(quality.features(r.text or "", buckets)) >= 0.3}
    assert {r.doc_id for r in after} == good and 0 < len(good) < len(before)
    before, after = seen[1]
    ids = [r.doc_id for r in before]
    first = plain_components(ids, [plain_fingerprint(r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted(i for i, c in zip(ids, first) if i == c)
    before, after = seen[2]
    items = [decontaminate.words(r.text) for r in table("benchmark").collect()]
    limit = lambda w: len(w) // 5
    code = {w: k + 1 for k, w in enumerate({w for i in items for w in i})}
    coded = [np.array([code[w] for w in i]) for i in items]
    clean = []
    for r in before:
        text = np.array([code.get(w, 0) for w in decontaminate.words(r.text)], np.int64)
        if all(decontaminate.least_edits(i, text)[0] > limit(i) for i in coded):
            clean.append(r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(clean) and len(clean) < len(before)
    before, after = seen[3]
    assert {r.doc_id: r.text for r in after} == {r.doc_id: masked(r.text) for r in before}
    assert all(r.n_chars == len(r.text) for r in after)
    assert any(secrets.REDACTED in r.text for r in after) == any(plain_spans(r.text) for r in before)
    rows = steps[-1](spark, docs, SMALL).collect()
    plain = packing.WordTokenizer(packing.default_tokenizer()).tokenizer
    assert sum(r.length for r in rows) == sum(len(whole_text_ids(plain, r.text)) for r in seen[3][1])
    check_sequences(rows, 4096)


def test_run_is_the_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SMALL)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(
        map(tuple, docs.select("doc_id", "piece", "length", "ids_crc32").collect())
    )


def test_order_of_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_edges(spark, tmp_path):
    for k, docs in enumerate((edge_documents(spark), no_documents(spark))):
        folder = f"{tmp_path}/{k}"
        docs.write.parquet(f"{folder}/documents.parquet")
        label_rows(spark, [(1, 1, 0), (8, 0, 0), (5, 1, 0)]).write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, None), (2, "word then")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        rows = corpus_pipeline.run(spark, folder).collect()
        assert bool(rows) == (k == 0)
    assert simhash.keep_one(docs).columns == docs.columns
