"""Quality classifier: logistic regression on hashed word n-grams, trained
with follow-the-regularised-leader updates (FTRL-proximal, McMahan et al.).

A text's words and punctuation runs, and pairs of neighbours, are hashed to
2^18 features; a pair of equal neighbours is one feature whatever the word.
Features are weighted by 1 + log(count), scaled to unit length (short texts to less).  A score is
the sparse dot product of a text's features with the weights, through the
logistic function.

Training reads labelled rows only.  It takes all of them up to ``max_rows``
(default 12,000), beyond that a sample by hash of the id; their features are
made on the executors and a single task, whose input that bound limits,
updates the weights.  The weights (2 MB) are then the same constant for every
scoring task.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, positional, with_package

FEATURE_BITS = 18
MAX_TRAIN_ROWS = 12_000
EPOCHS = 2
#: Added to the squared length of a feature vector: short texts stay nearer the prior.
DAMPING = 30.0
#: FTRL: learning rate, its smoothing, L1 and L2 strength (some 850 of the 262,144
#: weights are not zero on sf0.1, at the accuracy that no penalty gives).
ALPHA, BETA, L1, L2 = 10.0, 1.0, 0.1, 0.01
#: Words whose hash a Python worker remembers; words hashed at once.
CACHE_ROWS, BLOCK = 100_000, 1 << 17

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_MASK = np.uint64((1 << FEATURE_BITS) - 1)
_SAME = np.uint64(zlib.crc32(b"same word twice")) & _MASK
_known: dict[str, int] = {}


def _hashes(words: list[str]) -> np.ndarray:
    try:
        return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))
    except KeyError:
        if len(_known) > CACHE_ROWS:
            _known.clear()
        _known.update((w, zlib.crc32(w.encode())) for w in set(words).difference(_known))
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(sorted feature numbers, their weights) of a whole text; none if it is null or empty."""
    words = _TOKEN.findall((text or "").lower())
    counts: dict[int, int] = {}
    parts = []
    for i in range(0, len(words), BLOCK):  # neighbours across blocks share a word
        h = _hashes(words[i:i + BLOCK + 1])
        pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(40)
        pairs = np.where(h[:-1] == h[1:], _SAME, pairs & _MASK)
        ids, n = np.unique(np.concatenate((h[:BLOCK] & _MASK, pairs)), return_counts=True)
        parts.append((ids, n))
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    if len(parts) > 1:
        for ids, n in parts:
            for k, c in zip(ids.tolist(), n.tolist()):
                counts[k] = counts.get(k, 0) + c
        ids = np.array(sorted(counts))
        n = np.array([counts[k] for k in ids.tolist()])
    x = 1.0 + np.log(n)
    x /= np.sqrt((x * x).sum() + DAMPING)
    return ids.astype(np.int32), x.astype(np.float32)


class Ftrl:
    """Weights of a logistic regression with per-feature learning rates; the
    constant term is the labels' prior log-odds, so a text that says nothing
    scores as the average row."""

    def __init__(self, prior: float):
        self.z = np.zeros(1 << FEATURE_BITS)
        self.n = np.zeros(1 << FEATURE_BITS)
        self.bias = log_odds(prior)

    @staticmethod
    def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def weights(self) -> np.ndarray:
        return self._weights(self.z, self.n)

    def update(self, ids: np.ndarray, x: np.ndarray, label: int) -> None:
        z, n = self.z[ids], self.n[ids]
        w = self._weights(z, n)
        g = (logistic(x @ w + self.bias) - label) * x
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA
        self.z[ids] = z + g - sigma * w
        self.n[ids] = n + g * g


def logistic(v: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(v, -35, 35))))


def log_odds(p: float) -> float:
    p = min(max(p, 0.01), 0.99)
    return float(np.log(p / (1 - p)))


def in_test_fold(id_col: str = "doc_id"):
    """Rows whose labels are never learned from; a null id is not one of them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", max_rows: int = MAX_TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """(weights, prior log-odds) learned from the labelled rows of ``docs``
    outside the test fold.

    Labels other than 0 and 1 and null ids are left out; no rows at all give
    zero weights and even odds.  An id counts once: with the label that most of
    its labels have (1 of as many), and the largest of its texts.  About ``max_rows`` labels are used, all if
    there are no more; which ones and in what order depends on their id only.
    """
    known = labels.select(F.col(id_col).alias("__lid"), F.col(label_col).cast("int").alias("__y")).filter(
        ~in_test_fold("__lid") & F.col("__lid").isNotNull() & F.col("__y").isin(0, 1))
    known = known.groupBy("__lid").agg(F.round(F.avg("__y")).cast("int").alias("__y"))
    share = min(1.0, max_rows / max(1, known.count()))
    order = F.pmod(F.xxhash64(F.col("__lid").cast("string")), F.lit(1 << 30))
    chosen = materialise(known.filter(order < int(share * (1 << 30))), "labels")
    prior = chosen.agg(F.avg("__y")).first()[0]
    prior = 0.5 if prior is None else prior
    slim = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    rows = slim.join(F.broadcast(chosen), F.col("__id") == F.col("__lid")).select("__lid", "__y", "__text")
    rows = rows.groupBy("__lid").agg(F.first("__y").alias("__y"), F.max("__text").alias("__text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [features(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([i.tobytes() for i, _ in made], pa.binary()),
                 pa.array([x.tobytes() for _, x in made], pa.binary())], ["__lid", "y", "ids", "x"])

    sparse = materialise(with_package(rows).mapInArrow(
        extract, f"__lid {chosen.dtypes[0][1]}, y int, ids binary, x binary"), "features")
    sparse = sparse.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(EPOCHS)))).withColumn(
        "o", F.xxhash64(F.col("__lid").cast("string"), "epoch"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Ftrl(prior)
        for b in batches:
            for y, ids, x in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                ids = np.frombuffer(ids.as_buffer(), np.int32)
                if len(ids):
                    model.update(ids, np.frombuffer(x.as_buffer(), np.float32).astype(np.float64), y)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights().astype(np.float32).tobytes()], pa.binary())], ["w"])

    # the bound on the rows makes this one task's work a constant
    one = sparse.repartition(1).sortWithinPartitions("epoch", "o", "__lid", "ids").select("y", "ids", "x")
    got = with_package(one).mapInArrow(learn, "w binary").collect()
    w = np.frombuffer(got[0][0], np.float32) if got else np.zeros(1 << FEATURE_BITS, np.float32)
    return w, log_odds(prior)


def score(docs: DataFrame, model: tuple[np.ndarray, float], keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns of ``docs`` and ``__score`` (0 to 1), from the text alone."""
    w, bias = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = []
            for t in b.column(b.num_columns - 1):
                ids, x = features(t.as_py())
                scores.append(logistic(float(x.astype(np.float64) @ w[ids].astype(np.float64)) + bias))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores, pa.float64())], names)

    slim = docs.select(*keep, F.col(text_col).alias("__text"))
    names = [*keep, "__score"]
    return with_package(slim).mapInArrow(
        run, ", ".join(f"`{n}` {t}" for n, t in slim.dtypes[:-1]) + ", __score double")


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id",
            text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """One row per row of ``docs``: (id, held_out, score, predicted).

    ``held_out`` marks the test fold.  Null and empty texts score the labels'
    prior, like any text without features; texts are read whole, however long.  Rows with a null id are scored and
    never held out; repeated rows score alike; an empty table gives an empty
    result; other columns are ignored.
    """
    model = train(docs, labels, label_col, id_col, text_col, max_rows)
    out = score(docs, model, [id_col], text_col)
    return out.select(id_col, in_test_fold(id_col).alias("held_out"), F.col("__score").alias("score"),
                      (F.col("__score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id",
              text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """``docs`` that score ``threshold`` or more, all columns kept; nulls as in ``quality``."""
    rows, (key, text) = positional(docs, id_col, text_col)
    model = train(rows.withColumnRenamed(key, id_col), labels, label_col, id_col, text, max_rows)
    good = score(rows, model, rows.columns, text).filter(F.col("__score") >= threshold)
    return good.select(*rows.columns).toDF(*docs.columns)
