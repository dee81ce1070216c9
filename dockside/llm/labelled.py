"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bound of the labelled rows that a classifier is fitted on.
MAX_TRAIN_ROWS = 12_000


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True where crc32 of the id as text leaves ``fold``; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, *, folds: int, fold: int, max_rows: int = MAX_TRAIN_ROWS
) -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` rows, a labelled id outside the held-out fold each.

    The ids are the first by a hash of the id, so the sample is random, the same in every run, and bounded; only it
    is broadcast.  Several label rows of one id: the larger label counts.  Null ids and labels are left out, a null
    text is empty, and of documents that share an id the text with the smallest hash is taken.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("double").alias("label")).where(
        F.col("_id").isNotNull() & F.col("label").isNotNull()
    )
    chosen = (
        known.where(~held_out(F.col("_id"), folds, fold))
        .groupBy("_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    )
    texts = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return (
        texts.join(F.broadcast(chosen), texts.doc_id == F.col("_id"))
        .groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "label")).alias("x"))
        .select("doc_id", "x.text", "x.label")
    )
