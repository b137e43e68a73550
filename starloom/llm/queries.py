"""The registered queries of the pipeline operators: each applies its operator
to its whole table, with production parameters, and returns the whole result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (exact_dedup, html_extract, importance, infill, neighbours, quality, secret_scan, sentence_pieces,
               simhash, source_mix, token_counts, toxicity, url_filter)
from .common import table, tokenizer_path


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix_sources(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op4_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.infill_digests(table(spark, sf_dir, "documents"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_source_mix": op2_source_mix,
    "op3_simhash": op3_simhash,
    "op4_sentence_pieces": op4_sentence_pieces,
    "op5_html_extract": op5_html_extract,
    "op6_quality": op6_quality,
    "op7_secret_scan": op7_secret_scan,
    "op8_token_counts": op8_token_counts,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_neighbours": op10_neighbours,
    "op11_toxicity": op11_toxicity,
    "op12_infill": op12_infill,
    "op13_importance": op13_importance,
}

SQL = {
    "op1_url_filter": url_filter.sql(),
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op12_infill": infill.sql(),
}
