"""Training-data pipeline over ``documents``: five stages, each one operator of ``kpiloom.llm``.

Every stage takes what its predecessor kept, written as Parquet and read again,
and its decisions take effect: documents or lines that it rejects are gone.  All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.common import saved, table
from kpiloom.llm.decontaminate import drop_contaminated
from kpiloom.llm.knn_quality import keep_good
from kpiloom.llm.line_dedup import REMOVED, dedup_lines
from kpiloom.llm.near_dedup import keep_one
from kpiloom.llm.packing import pack_documents
from kpiloom.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled vectors call good."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less the line runs that an earlier document (or place) has; texts that lose all go."""
    left = dedup_lines(docs).where((F.size(REMOVED) == 0) | (F.trim(F.translate("text", "\n\t\r", "")) != ""))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (word shingles 0.8 alike or more)."""
    return keep_one(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents and their places in sequences."""
    return pack_documents(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("near_dedup", near),
    ("decontamination", benchmarks),
    ("packing", packing),
]

#: SQL can't express the classifier, the fingerprints or the tokenizer; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
