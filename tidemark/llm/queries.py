"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.byte_bpe import encoded
from tidemark.llm.common import table
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.fingerprints import order_fingerprints
from tidemark.llm.jaccard import jaccard_components
from tidemark.llm.licenses import licenses
from tidemark.llm.minhash import minhash_components
from tidemark.llm.mixing import mix
from tidemark.llm.quality import scored
from tidemark.llm.spelling import spelling_variants
from tidemark.llm.token_counts import token_counts
from tidemark.llm.warc import archived_pages
from tidemark.llm.wavelet import token_file
from tidemark.llm.whitening import whiten


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_fingerprints(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), with_ids=False)


def op7_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_components(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_order_minhash": op1_order_minhash,
    "op2_token_counts": op2_token_counts,
    "op3_mix": op3_mix,
    "op4_licenses": op4_licenses,
    "op5_quality": op5_quality,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_wavelet": op7_wavelet,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_warc": op9_warc,
    "op10_jaccard": op10_jaccard,
    "op11_whitening": op11_whitening,
    "op12_spelling": op12_spelling,
    "op13_minhash": op13_minhash,
}
