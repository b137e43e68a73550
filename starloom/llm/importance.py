"""Target-distribution importance resampling (DSIR) on hashed word n-grams.

The features of a text are its runs of one and two consecutive words, each
hashed to a bucket by CRC-32.  How much commoner a bucket is in the target
texts than in the raw ones is its gain; a document's weight is the mean gain
of its features; weight plus Gumbel noise drawn from its id is its score, and
the highest scores are drawn without replacement.

Hashing works on a batch's bytes at once: words joined by single spaces, and
the n-grams of one order that start every n-th word are disjoint spans, so n
passes of ``crc32_spans`` hash all of them.

Counts are summed in each task before they shuffle (a task gives one row per
bucket).  Ranks need no order of all documents: a histogram of the whole-number
scores gives the score that the last drawn document has, and only documents
that reach it are range-partitioned and numbered.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, positional, with_package
from .crc_spans import crc32_spans

BUCKETS = 10_000
MAX_N = 2
#: Documents with fewer words are scored and never drawn.
MIN_WORDS = 20
#: Share (%) of the others that is drawn.
DRAW_PERCENT = 25
SEED = 7
#: Bytes of words that are hashed at once.
BLOCK_BYTES = 1 << 22

_SPACE = 0x20
# Lower-cases A-Z; every other ASCII character but a-z and 0-9 becomes a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else _SPACE for b in range(256))


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all words, each followed by one space; where each word starts;
    words of each text)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    data = np.frombuffer(b" ".join((*texts, b"")).translate(_FOLD), np.uint8)
    letter = data != _SPACE
    after = np.concatenate(([False], letter[:-1]))
    begins = np.nonzero(letter & ~after)[0]
    per_text = np.diff(np.searchsorted(begins, np.concatenate(([0], np.cumsum(sizes)))))
    kept = data[letter | after]
    starts = np.concatenate(([0], np.nonzero(kept == _SPACE)[0] + 1))[:-1]
    return kept, starts, per_text


def features(texts: list[bytes], buckets: int = BUCKETS, max_n: int = MAX_N) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature, the text it is of, words of each text)."""
    data, starts, per_text = _words(texts)
    ends = np.append(starts[1:], len(data)) - 1  # the space before the next word
    text = np.repeat(np.arange(len(texts)), per_text)
    found, owner = [], []
    for n in range(1, max_n + 1):
        for phase in range(n):
            at = np.arange(phase, len(starts) - n + 1, n)
            at = at[text[at] == text[at + n - 1]]
            for part in _parts(at, starts, ends, n):
                found.append((crc32_spans(data, starts[part], ends[part + n - 1]) % buckets).astype(np.int32))
                owner.append(text[part])
    return (np.concatenate(found) if found else np.zeros(0, np.int32),
            np.concatenate(owner) if owner else np.zeros(0, np.int64), per_text)


def _parts(at: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """``at`` in pieces whose spans hold about ``BLOCK_BYTES`` bytes."""
    if not len(at):
        return
    upto = np.cumsum(ends[at + n - 1] - starts[at])
    yield from (p for p in np.split(at, np.searchsorted(upto, np.arange(BLOCK_BYTES, upto[-1], BLOCK_BYTES))) if len(p))


def _slabs(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of pieces of an Arrow column with about ``BLOCK_BYTES`` bytes."""
    first, held, size = 0, [], 0
    for i, t in enumerate(column):
        t = t.as_py()
        held.append(t or b"")
        size += len(held[-1])
        if size >= BLOCK_BYTES:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, max_n: int = MAX_N) -> np.ndarray:
    """How many features of all texts are in each bucket.  A task sums its own
    rows; the result has ``buckets`` numbers whatever the data."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for b in batches:
            for _, texts in _slabs(b.column(0)):
                sums += np.bincount(features(texts, buckets, max_n)[0], minlength=buckets)
        some = np.nonzero(sums)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(sums[some], pa.int64())], ["bucket", "n"])

    slim = docs.select(F.col(text_col).cast("binary").alias("__text"))
    rows = with_package(slim).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows:  # no more than ``buckets`` rows
        out[bucket] = n
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much commoner each bucket is in the target, both
    counts raised by one."""
    s_all, t_all, b = int(raw.sum()), int(target.sum()), len(raw)
    return np.array([math.floor(1000 * math.log(float((int(t) + 1) * (s_all + b)) / float((int(s) + 1) * (t_all + b))))
                     for s, t in zip(raw, target)], np.int64)


def noise(h: int) -> int:
    """floor(1000 times a standard Gumbel draw) from a 32-bit number."""
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _draw(id_col: str, seed: int) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def score_documents(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
                    max_n: int = MAX_N, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (the id) of ``docs`` with (__words, __features, __weight, __score)."""
    keep = [id_col] if keep is None else keep
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, count, total = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for first, texts in _slabs(b.column(b.num_columns - 1)):
                bucket, owner, per_text = features(texts, buckets, max_n)
                rows = slice(first, first + len(texts))
                words[rows] = per_text
                count[rows] = np.bincount(owner, minlength=len(texts))
                order = np.argsort(owner, kind="stable")
                upto = np.concatenate(([0], np.cumsum(gains[bucket[order]])))
                edge = np.concatenate(([0], np.cumsum(count[rows])))
                total[rows] = upto[edge[1:]] - upto[edge[:-1]]
            weight = total // np.maximum(count, 1)
            score = weight + np.fromiter(map(noise, b.column(b.num_columns - 2).to_pylist()), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-2], *(pa.array(x, pa.int64()) for x in (words, count, weight, score))], names)

    slim = docs.select(*keep, _draw(id_col, seed).alias("__h"), F.col(text_col).cast("binary").alias("__text"))
    names = [*keep, "__words", "__features", "__weight", "__score"]
    kinds = ", ".join(f"`{n}` {t}" for n, t in slim.dtypes[:-2])
    return with_package(slim).mapInArrow(
        run, kinds + ", __words long, __features long, __weight long, __score long")


def _ranked(scored: DataFrame, id_col: str, min_words: int, percent: int) -> DataFrame:
    """``scored`` (stored rows) with ``__rank``, null for those not drawn."""
    fit = F.col("__words") >= min_words
    # whole-number scores: some 60,000 values at most, whatever the number of rows
    histogram = scored.filter(fit).groupBy("__score").count().orderBy(F.desc("__score")).collect()
    draw = percent * sum(n for _, n in histogram) // 100
    least, above = None, 0
    for value, n in histogram:
        if above >= draw:
            break
        least, above = value, above + n
    if least is None:
        return scored.withColumn("__rank", F.lit(None).cast("long"))
    near = fit & (F.col("__score") >= least)
    # equal rows of one id are told apart too, so that none of their groups stays in one range
    order = [F.desc("__score"), F.asc_nulls_last(id_col), F.asc("__features"), F.asc("__row")]
    ranged = materialise(scored.filter(near).withColumn("__row", F.monotonically_increasing_id())
                         .repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "drawn")
    counts = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    # one row per range partition
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    within = Window.partitionBy("__part").orderBy(*order)
    ranked = ranged.join(F.broadcast(offsets), "__part").withColumn(
        "__rank", (F.col("__before") + F.row_number().over(within)).cast("long"))
    ranked = ranked.withColumn("__rank", F.when(F.col("__rank") <= draw, F.col("__rank")))
    rest = scored.filter(~near).withColumn("__rank", F.lit(None).cast("long"))
    return ranked.select(*rest.columns).unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", buckets: int = BUCKETS, max_n: int = MAX_N, min_words: int = MIN_WORDS,
             draw_percent: int = DRAW_PERCENT, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: (id, n_features, weight, score, rank), all long.

    ``rank`` counts the drawn documents from 1, highest score first, ties to
    the smaller id (null ids last, equal rows in any order); it is null for
    the others.  Null and empty texts have no features and weight 0; like all
    texts of fewer than ``min_words`` words they are scored but not drawn.  The
    noise depends on the id alone (a null id draws as the empty string).  Texts
    are read whole, however long.  An empty table gives an empty result, an
    empty target gains from counts of one; other columns are ignored.
    """
    gains = bucket_gains(bucket_counts(docs, text_col, buckets, max_n),
                         bucket_counts(target, target_text_col, buckets, max_n))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    scored = materialise(score_documents(rows, gains, "__id", "__text", max_n, seed), "scored")
    out = _ranked(scored, "__id", min_words, draw_percent)
    return out.select(F.col("__id").cast("long").alias(id_col), F.col("__features").alias("n_features"),
                      F.col("__weight").alias("weight"), F.col("__score").alias("score"), F.col("__rank").alias("rank"))


def draw_documents(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   target_text_col: str = "text", buckets: int = BUCKETS, max_n: int = MAX_N,
                   min_words: int = MIN_WORDS, draw_percent: int = DRAW_PERCENT, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` that ``resample`` draws, with all their columns."""
    rows, (key, text) = positional(docs, id_col, text_col)
    gains = bucket_gains(bucket_counts(rows, text, buckets, max_n),
                         bucket_counts(target, target_text_col, buckets, max_n))
    scored = materialise(score_documents(rows, gains, key, text, max_n, seed, rows.columns), "scored")
    drawn = _ranked(scored, key, min_words, draw_percent).filter(F.col("__rank").isNotNull())
    return drawn.select(*rows.columns).toDF(*docs.columns)
