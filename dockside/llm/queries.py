"""Registered queries of the corpus operators: (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dockside.llm.oracles import ORACLES as ORACLES
from dockside.llm import (
    decontaminate, lm_score, mixing, packing, phrases, quality, secrets, sharding, simhash, spelling, toxicity, url_rules,
    weak_rules,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_rules.judge(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.cluster(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(found.fp).alias("fingerprint"), "component_id")


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rule_table(spark))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.word_cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "conversations"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), sharding.shard_names())


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_secrets": op2_secrets,
    "op3_quality": op3_quality,
    "op4_packing": op4_packing,
    "op5_quality_rules": op5_quality_rules,
    "op6_decontamination": op6_decontamination,
    "op7_simhash": op7_simhash,
    "op8_url_rules": op8_url_rules,
    "op9_lm_score": op9_lm_score,
    "op10_sharding": op10_sharding,
    "op11_phrases": op11_phrases,
    "op12_spelling": op12_spelling,
    "op13_mixing": op13_mixing,
}
