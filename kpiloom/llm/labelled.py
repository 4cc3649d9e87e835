"""The bounded, documented sample of labelled documents that the trained models are fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(doc_id: Column) -> Column:
    """crc32 of the id's text modulo 5; fold 0 is held out of all training."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def training_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, quality) of at most ``rows`` labelled documents outside the held-out fold.

    Taken in the order of a hash of the id.  Labels that are null, or that
    contradict each other for an id, are left out; documents without an id too.
    """
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != 0))
                    .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
                    .where("quality = most").drop("most")
                    .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return (docs.select("doc_id", F.col("text").cast("string").alias("text"))
                .join(F.broadcast(chosen), "doc_id")                     # at most ``rows`` ids
                .groupBy("doc_id", "quality").agg(F.max("text").alias("text"))
                .select("text", "quality"))
