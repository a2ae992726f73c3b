"""The registered queries opN_<name>: each operator over its whole table, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.llm import decontaminate, licenses, merkle, minhash, ngram_join, pieces, sketches, substring_dedup, token_files, toxicity, url_filter, warc, whitening
from pitpanel.llm.text import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(decontaminate.mark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merkle.manifest(table(spark, sf_dir, "documents"), tampered=merkle.without_line_feeds())
    proof = F.sha2(F.col("siblings").cast("binary"), 256)
    return out.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", "verified")


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.edited_likeness(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.segment(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), digest=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_toxicity": op2_toxicity,
    "op3_url_filter": op3_url_filter,
    "op4_license_scan": op4_license_scan,
    "op5_ngram_join": op5_ngram_join,
    "op6_fingerprints": op6_fingerprints,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_token_files": op8_token_files,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_decontamination": op10_decontamination,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_minhash_dedup": op12_minhash_dedup,
    "op13_whitening": op13_whitening,
}
