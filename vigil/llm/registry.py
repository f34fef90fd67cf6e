"""The registered queries of the operators in this package, and their SQL (`oracle.py`)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.llm.common import package_on_workers
from vigil.llm.embedding_dedup import embedding_groups
from vigil.llm.exact_dedup import exact_groups
from vigil.llm.html_text import extract_text
from vigil.llm.license_scan import scan_licenses
from vigil.llm.mixing import mix_sources
from vigil.llm.near_dedup import near_groups
from vigil.llm.oracle import LLM_ORACLE
from vigil.llm.packing import pack_documents
from vigil.llm.personal_data import find_personal_data, train_skip_chain
from vigil.llm.substring_dedup import repeated_spans
from vigil.llm.token_alignment import align_documents
from vigil.llm.toxicity import held_out_fold, score_toxicity, train_toxicity
from vigil.llm.whitening import fit_whitening, whiten
from vigil.llm.window_dedup import repeated_windows


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    package_on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents")).drop("detections")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(_table(spark, sf_dir, "documents"))


def op3_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return find_personal_data(docs, train_skip_chain(docs))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(_table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(docs, _table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", F.coalesce(held_out_fold(), F.lit(False)).alias("held_out"), "score", "predicted")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return repeated_spans(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return whiten(rows, fit_whitening(rows))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.encode("groups", "UTF-8"), 256))
    return align_documents(_table(spark, sf_dir, "documents")).withColumn("groups_sha256", digest).drop("groups")


def op13_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    found = repeated_windows(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", removed.alias("n_removed"), "kept_sha256")


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_near_dedup,
        op3_best_two_fit,
        op4_personal_data,
        op5_main_text,
        op6_mix_sources,
        op7_embedding_dedup,
        op8_toxicity,
        op9_suffix_dedup,
        op10_exact_dedup,
        op11_whitening,
        op12_token_alignment,
        op13_window_dedup,
    )
}

__all__ = ["LLM_ORACLE", "LLM_QUERIES"]
