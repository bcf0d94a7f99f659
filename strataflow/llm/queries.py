"""The numbered operators as queries over the given tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataflow.llm import bitplanes, bpe, compression, fingerprints, jaccard, language, licenses, lines, mixing, near, repeats, runs, warc
from strataflow.sources import scratch_path


def _load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write_warc(_load(spark, sf_dir, "pages"), folder)
    return warc.payloads(warc.read_warc(spark, folder, with_payload=False)).drop("record_id")


def compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.compression_bands(_load(spark, sf_dir, "documents"))


def bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(_load(spark, sf_dir, "documents"))


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(_load(spark, sf_dir, "documents"))


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_load(spark, sf_dir, "documents"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_load(spark, sf_dir, "documents"))


def without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_load(spark, sf_dir, "documents")).drop("spans")


def mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(_load(spark, sf_dir, "documents").select("doc_id", "source"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(_load(spark, sf_dir, "documents"))


def fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_counts(_load(spark, sf_dir, "documents"))


def shingle_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components_of(_load(spark, sf_dir, "documents"))


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_counts(runs.planted(_load(spark, sf_dir, "documents")))


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.cluster_report(_load(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": warc_records,
    "op2_compression_bands": compression_bands,
    "op3_suffix_dedup": without_repeats,
    "op4_mix_sources": mixed_sources,
    "op5_bpe": bpe_tokens,
    "op6_license_scan": license_scan,
    "op7_fuzzy_lines": fuzzy_lines,
    "op8_order_minhash": near_duplicates,
    "op9_fingerprint": document_fingerprints,
    "op10_language_id": languages,
    "op11_ngram_jaccard": shingle_components,
    "op12_periodic_runs": periodic_runs,
    "op13_bitplane_clusters": clusters,
}

ORACLE: dict[str, str] = {
    "op4_mix_sources": mixing.ORACLE_SQL,
    "op11_ngram_jaccard": jaccard.ORACLE_SQL,
    "op12_periodic_runs": runs.ORACLE_SQL,
    "op13_bitplane_clusters": bitplanes.ORACLE_SQL,
}
