"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.common import table
from kpiloom.llm.decontaminate import contaminated
from kpiloom.llm.knn_quality import score_quality
from kpiloom.llm import secret_scan, spelling
from kpiloom.llm.line_crf import label_lines
from kpiloom.llm.line_dedup import REMOVED, dedup_lines
from kpiloom.llm.near_dedup import near_duplicates
from kpiloom.llm.packing import pack_documents
from kpiloom.llm import periodic
from kpiloom.llm.related_packing import pack_related
from kpiloom.llm.sharding import shard_documents
from kpiloom.llm.substring_dedup import repeated_spans
from kpiloom.llm.url_filter import filter_urls


def vocabulary() -> str:
    """The public vocabulary file that packing counts tokens with."""
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.size(REMOVED).alias("n_removed"), F.array_join(REMOVED, ",").alias("removed_lines"),
                      F.length("text").alias("n_kept_chars"),
                      F.crc32(F.encode("text", "UTF-8")).alias("kept_crc32"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(table(spark, sf_dir, "documents"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft", "soft_weight")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan_secrets(table(spark, sf_dir, "documents")))


def op7_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_lines(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_related_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_related(table(spark, sf_dir, "documents"), vocabulary())


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spelling.word_counts(table(spark, sf_dir, "documents"), damaged=spelling.DAMAGED)
    return spelling.variant_groups(counts.where(F.col("n") >= spelling.MIN_COUNT))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse_runs(table(spark, sf_dir, "documents"), rewrite=periodic.repeated_from)
    return periodic.digest(found)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_substring_dedup, op2_line_dedup, op3_sharding, op4_near_dedup, op5_url_filter, op6_secret_scan,
        op7_line_crf, op8_quality_knn, op9_packing, op10_decontamination, op11_related_packing, op12_spelling_variants, op13_periodic_runs)}
