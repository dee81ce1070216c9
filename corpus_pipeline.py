"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept.  Stages but the last return the
columns of documents.  Between stages the documents are a Parquet table, so a stage that is lost is run again from
what is written.

1. quality: rejects documents that the quality classifier predicts to be bad; unlabelled ones are judged too.
2. near_duplicates: one document of each group of SimHash neighbours stays, that with the smallest id.
3. decontamination: documents with a passage near a benchmark item go.
4. secrets: spans of secrets are masked, no document goes.
5. packing: the pieces of every document, and the sequence and place where each lies.

Edge cases are those of the operators: null texts are empty documents, null ids are kept apart, repeated rows are one
document after stage 2, an empty table stays empty, and extra columns are carried as far as stage 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dockside.llm import decontaminate, packing, quality, secrets, simhash
from dockside.llm.queries import table
from dockside.plans.staging import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: A trained classifier, hashes and a tokenizer: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
