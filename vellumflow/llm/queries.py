"""The registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import audit, bpe, fingerprint, lloyd, neardup, packing, quality, runtime, secrets, sql, substring, tokencount, topk, toxicity, wavelet


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(runtime.documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(runtime.documents(spark, sf_dir), runtime.labels(spark, sf_dir))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.report(runtime.documents(spark, sf_dir))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(runtime.documents(spark, sf_dir))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(runtime.documents(spark, sf_dir), runtime.labels(spark, sf_dir))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.encode_files(runtime.documents(spark, sf_dir), tokenizer_path(), end_id=2)


def op7_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(runtime.documents(spark, sf_dir), tokenizer_path())


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.report(runtime.documents(spark, sf_dir))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.report(runtime.documents(spark, sf_dir))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.report(runtime.documents(spark, sf_dir), runtime.labels(spark, sf_dir))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.report(runtime.documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_secret_scan": secrets.sql(),
        "op4_packing": sql.packs(),
        "op8_ngram_jaccard": sql.near_duplicates(),
        "op9_exact_top_k": topk.sql(),
        "op10_substring_dedup": sql.substrings(),
        "op11_vector_codes": lloyd.sql(),
        "op12_filter_audit": audit.sql(),
    }
