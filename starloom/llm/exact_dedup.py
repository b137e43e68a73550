"""Exact duplicates by two passes over a Bloom filter.

Pass 1 sets two bits for each text's hash in a register-blocked Bloom filter
(both bits in one 64-bit word) and keeps the bits that two rows or more have
set.  Pass 2 tests every row against those repeated bits: a row with a bit
that nobody else set has no copy and passes straight through; only the
possible repeats are shuffled, grouped by SHA-256 and decided exactly.

What shuffles of a possible repeat is its digest and id (``exact_dedup``), or
its digest, id and other small columns (``drop_copies``).  Whole texts move
only if more than ``MAX_BROADCAST_GROUPS`` texts are repeated: then possible
repeats meet the decision on their text by a shuffle.

The filter is broadcast, and so has a ceiling (``max_filter_bits``, default
2^30 bits): it gets 16 bits a row up to there, 64 million rows.  Beyond, more
unique rows are taken for possible repeats (5% at 100 million rows, half of
them at 600 million); results stay exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup_groups, materialise, positional

BITS_PER_ROW = 16
MAX_FILTER_BITS = 1 << 30
#: Repeated texts whose decisions (some 100 bytes each) are broadcast.
MAX_BROADCAST_GROUPS = 1 << 17


def text_digest(text: str) -> Column:
    """Lower-case hex SHA-256 of a text; null counts as empty."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def filter_words(rows: int, max_filter_bits: int = MAX_FILTER_BITS) -> int:
    """64-bit words of the filter: a power of two, 16 bits a row up to the ceiling."""
    bits = 1 << max(10, (max(1, rows) * BITS_PER_ROW - 1).bit_length())
    return min(bits, max_filter_bits) // 64


def _probe(digests: DataFrame, words: int) -> DataFrame:
    h = F.xxhash64("__sha")
    return (digests.withColumn("__word", F.shiftrightunsigned(h, 12) % F.lit(words))
            .withColumn("__bit1", h.bitwiseAND(F.lit(63)).cast("int"))
            .withColumn("__bit2", F.shiftright(h, 6).bitwiseAND(F.lit(63)).cast("int")))


def repeated_bits(digests: DataFrame, words: int) -> DataFrame:
    """Pass 1: (__fword, __mask), the bits of each word that two rows or more set."""
    p = _probe(digests, words)
    bits = p.select("__word", F.explode(F.array_distinct(F.array("__bit1", "__bit2"))).alias("__b"))
    twice = bits.groupBy("__word", "__b").count().filter("count >= 2")
    return twice.groupBy(F.col("__word").alias("__fword")).agg(
        F.bit_or(F.expr("shiftleft(1L, __b)")).alias("__mask"))


def mark_candidates(digests: DataFrame, seen_twice: DataFrame, words: int) -> DataFrame:
    """Pass 2: adds ``__maybe``, false only for rows that surely have no copy."""
    p = _probe(digests, words).join(F.broadcast(seen_twice), F.col("__word") == F.col("__fword"), "left")
    hit = F.expr("(shiftright(__mask, __bit1) & 1L) = 1L AND (shiftright(__mask, __bit2) & 1L) = 1L")
    return p.withColumn("__maybe", F.coalesce(hit, F.lit(False))).select(*digests.columns, "__maybe")


def _seen_twice(digests: DataFrame, max_filter_bits: int) -> tuple[DataFrame, int, int]:
    """(repeated bits, words of the filter, rows) of stored digests."""
    n = digests.count()
    words = filter_words(n, max_filter_bits)
    return materialise(repeated_bits(digests, words), "bloom", words), words, n


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """One row per row of ``docs``: (id, keep_id, group_size, kept, text_sha256).

    Of equal texts the row with the largest id stays.  Whole texts of any length
    are compared.  A null text equals the
    empty one.  Null ids are smaller than any other (keep_id is null if a
    group has no other).  Repeated rows of one id and text each get a row; one
    of them is kept.  An empty table gives an empty result; other columns of
    ``docs`` are ignored.
    """
    digests = materialise(docs.select(F.col(id_col).alias("__id"), text_digest(text_col).alias("__sha")), "digests")
    seen_twice, words, n = _seen_twice(digests, max_filter_bits)
    marked = mark_candidates(digests, seen_twice, words)
    # copies are counted before they shuffle: a hot text is one row per task and id
    pairs = materialise(marked.filter("__maybe").groupBy("__sha", "__id").agg(F.count("*").alias("__n")),
                        "candidates", n)
    groups = materialise(pairs.groupBy("__sha").agg(
        F.max("__id").alias("__keep"), F.sum("__n").alias("__size")), "groups", n)
    decided = lookup_groups(pairs, groups, "__sha", "__size", n, F.col("__id"))
    alone = marked.filter(~F.col("__maybe")).select(
        F.col("__id").alias(id_col), F.col("__id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("__sha").alias("text_sha256"))
    one = F.lit(1).cast("long")
    copies = decided.withColumn("__i", F.explode(F.sequence(one, F.col("__n")))).select(
        F.col("__id").alias(id_col), F.col("__keep").alias("keep_id"), F.col("__size").alias("group_size"),
        (F.col("__id").eqNullSafe(F.col("__keep")) & (F.col("__i") == 1)).alias("kept"),
        F.col("__sha").alias("text_sha256"))
    return alone.unionByName(copies)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """``docs`` without exact copies, all columns kept.

    Rows that surely have no copy pass through unshuffled.  Of the possible
    repeats the row to keep is decided on digest, id and the other columns
    without the text: the largest id stays, among repeated rows of that id the
    largest by the other columns, of rows equal in all of them one.  Texts of
    any length are compared whole.  Nulls and empty tables as in ``exact_dedup``.
    """
    rows, (key, text) = positional(docs, id_col, text_col)
    order = [c for c, kind in rows.dtypes if c not in (key, text) and "map<" not in kind]
    keyed = rows.withColumns({"__sha": text_digest(text), "__k": F.struct(key, *order)})
    digests = materialise(keyed.select("__sha", "__k"), "digests")
    seen_twice, words, n = _seen_twice(digests, max_filter_bits)
    repeats = mark_candidates(digests, seen_twice, words).filter("__maybe")
    # copies are counted before they shuffle: a hot text is one row per task and id
    pairs = materialise(repeats.groupBy("__sha", "__k").agg(F.count("*").alias("__n")), "candidates", n)
    best = materialise(pairs.groupBy("__sha").agg(
        F.max("__k").alias("__keep"), F.max_by("__n", "__k").alias("__equal"), F.sum("__n").alias("__size")), "best", n)
    marked = mark_candidates(keyed, seen_twice, words)
    alone = marked.filter(~F.col("__maybe")).select(*rows.columns)
    met = lookup_groups(marked.filter("__maybe").select(*rows.columns, "__sha", "__k"), best, "__sha", "__size", n,
                        F.xxhash64("__k"), MAX_BROADCAST_GROUPS).filter(F.col("__k").eqNullSafe(F.col("__keep")))
    kept = met.filter("__equal = 1").select(*rows.columns)
    # rows equal in everything that is compared: each task keeps one before they meet
    one = met.filter("__equal > 1").groupBy("__sha").agg(F.first(F.struct(*rows.columns)).alias("__row"))
    return alone.unionByName(kept).unionByName(one.select("__row.*")).toDF(*docs.columns)
