"""The training-data pipeline: documents in, token ids of the kept ones out.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import exact_dedup, quality, sentence_pieces, simhash, source_mix
from starloom.llm.common import discard_stored, materialise, stored_tables, table, tokenizer_path


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the largest doc_id of equal texts."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of SimHash links."""
    return simhash.keep_one_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's share; a document taken twice is two rows."""
    return source_mix.take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_ids, ids, decoded_sha256, exact) of each document taken."""
    return sentence_pieces.round_trip(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality", good_documents),
    ("exact_dedup", exact_copies),
    ("simhash_dedup", near_copies),
    ("source_mix", mix),
    ("sentence_pieces", encode),
]

#: No SQL: a trained classifier, XXH64 fingerprints and piece ids aren't expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage applied to the documents table.  Once a stage's output is
    written, its own intermediate tables and its input go."""
    docs = table(spark, sf_dir, "documents")
    first = stored_tables()
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        discard_stored(spark, first, stored_tables() - 1)
    return docs
