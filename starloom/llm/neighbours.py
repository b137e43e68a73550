"""Nearest neighbours by collision-counting hashing.

Vectors are cut into blocks of bounded size.  A block keeps one sorted array
per projection.  A query looks, in every array, at the window centred on its
own projection; virtual rehashing widens all windows from level to level.  Of
an array only what the window newly takes in is read, or, once it holds most of
the block, what it still leaves out.  A vector that falls into the windows of
``THRESHOLD`` of the projections has collided often enough and is verified: its
inner product is computed on the original vectors.  A query is done with a
block when its k-th verified vector is so near that nearer ones would have
collided at this level almost surely; only if that never happens, as in blocks
of a few hundred vectors, the rest of the block is verified too.

Largest inner product becomes smallest distance by one extra coordinate, which
gives all vectors of a block the length of its longest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, with_package

#: Vectors of a block and queries that a task holds at once.
BLOCK_ROWS, CHUNK_QUERIES = 8192, 4096
#: Projections, and the share of them that must collide.
PROJECTIONS, THRESHOLD = 128, 0.85
#: Half width of a window in which vectors collide often enough almost surely,
#: as a multiple of their distance; the multiple that a query goes on to while
#: no more than that share of the block has been verified.
REACH, FAR_REACH, FEW = 1.55, 1.7, 0.04
#: Vectors of a block from whose k-th distances its windows are made, and the
#: quantiles of these that the windows reach from level to level.
SAMPLE, QUANTILES = 64, (0.5, 0.9, 1.0)


def projections(dim: int, count: int, seed: int = 7) -> np.ndarray:
    """(dim, count) projection vectors: stacked random orthogonal bases, scaled
    so that a projected difference is as long as the difference on average."""
    rng = np.random.default_rng(seed)
    bases = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-count // dim))]
    return np.concatenate(bases, axis=1)[:, :count] * np.sqrt(dim)


@dataclass(slots=True)
class _Search:
    """A query's state in a block: collisions of each vector, which are not
    verified, the windows counted so far, the k best places and their products."""

    hits: np.ndarray
    open: np.ndarray
    low: np.ndarray
    high: np.ndarray
    at: np.ndarray
    score: np.ndarray


class Block:
    """The sorted arrays of a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        norms = np.sqrt((self.vectors ** 2).sum(axis=1))
        self.length = norms.max()
        extra = np.sqrt(np.maximum(self.length ** 2 - norms ** 2, 0))
        self.axes = projections(vectors.shape[1] + 1, PROJECTIONS)
        seen = np.column_stack((self.vectors, extra)) @ self.axes / self.length
        order = np.argsort(seen, axis=0, kind="stable")
        self.sorted = np.take_along_axis(seen, order, axis=0).T.copy()
        self.order = order.T.astype(np.uint16 if len(self.ids) <= 1 << 16 else np.int64) 

    def widths(self, k: int) -> np.ndarray:
        """Half widths of the windows, in block lengths, from level to level:
        what the k-th distances of a few of the block's vectors call for."""
        some = np.unique(np.linspace(0, len(self.ids) - 1, SAMPLE).astype(np.int64))
        products = self.vectors[some] @ self.vectors.T
        products[np.arange(len(some)), some] = -np.inf
        k = min(k, len(self.ids) - 1)
        if not k:
            return np.array([2.0 * REACH])
        nearest = np.partition(products, -k, axis=1)[:, -k]
        lengths = np.sqrt((self.vectors[some] ** 2).sum(axis=1))
        far = np.sqrt(np.maximum(2 - 2 * nearest / (self.length * lengths), 0))
        far = np.quantile(far, QUANTILES)
        return np.unique(np.concatenate((far * REACH, far * FAR_REACH)))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the ids and inner products of its k nearest found."""
        return [(ids, score) for ids, score, _ in self.search_counted(query_ids, queries, k)]

    def search_counted(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        """``search`` with the number of vectors that were verified."""
        lengths = np.sqrt((queries ** 2).sum(axis=1))
        centre = ((queries / lengths[:, None]) @ self.axes[:-1]).T
        state = [self._open(q) for q in query_ids]
        todo = np.arange(len(query_ids))
        for width in self.widths(k):
            low = np.stack([np.searchsorted(s, c - width) for s, c in zip(self.sorted, centre[:, todo])])
            high = np.stack([np.searchsorted(s, c + width, "right") for s, c in zip(self.sorted, centre[:, todo])])
            more = [self._widen(state[q], queries[q], lengths[q], low[:, i], high[:, i], width, k)
                    for i, q in enumerate(todo)]
            todo = todo[np.array(more, bool)]
            if not len(todo):
                break
        for q in todo:  # the k-th is farther than any window reaches
            s = state[q]
            s.at, s.score = self._verify(np.flatnonzero(s.open), queries[q], s.at, s.score, k)
            s.open[:] = False
        return [(self.ids[s.at], s.score, len(self.ids) - 1 - np.count_nonzero(s.open)) for s in state]

    def _open(self, query_id: int) -> _Search:
        n = len(self.ids)
        start = np.zeros(len(self.order), np.int64)
        return _Search(np.zeros(n, np.int64), self.ids != query_id, start, start, np.zeros(0, np.int64), np.zeros(0))

    def _widen(self, s: _Search, query, length, low, high, width, k) -> bool:
        """Count what the windows newly take in, verify what has collided often
        enough; whether the query goes on."""
        n, count = len(self.ids), len(self.order)
        need = int(np.ceil(THRESHOLD * count))
        taken = (high - low).sum()
        known = (s.high - s.low).sum()
        if not known:
            s.low = s.high = low
        if taken - known <= count * n - taken:
            s.hits += self._count(low, s.low) + self._count(s.high, high)
        else:
            s.hits = count - self._count(np.zeros_like(low), low) - self._count(high, np.full_like(high, n))
        s.low, s.high = low, high
        s.at, s.score = self._verify(np.flatnonzero(s.open & (s.hits >= need)), query, s.at, s.score, k)
        s.open &= s.hits < need
        if len(s.at) < k:
            return True
        distance = np.sqrt(max(0.0, 2 - 2 * s.score[-1] / (self.length * length)))
        few = n - np.count_nonzero(s.open) <= FEW * n
        return bool(distance * (FAR_REACH if few else REACH) > width)

    def _count(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each vector stands between ``start`` and ``end`` of the arrays."""
        parts = [o[a:b] for o, a, b in zip(self.order, start.tolist(), end.tolist()) if a < b]
        return np.bincount(np.concatenate(parts), minlength=len(self.ids)) if parts else np.zeros(len(self.ids), np.int64)

    def _verify(self, new, query, at, score, k):
        """The k best of what was verified before and the new vectors; rows are
        in id order, so a stable sort leaves ties to the smaller id."""
        if not len(new):
            return at, score
        if len(new) > 8 * k:  # a fast product first leaves those that rounding could bring among the k best
            fast = (self.vectors @ query)[new] if 2 * len(new) > len(self.ids) else self.vectors[new] @ query
            slack = 1e-12 * len(query) * self.length * np.sqrt((query ** 2).sum())
            new = new[fast >= np.partition(fast, -k)[-k] - slack]
        at = np.concatenate((at, new))
        # summed row by row, so that equal vectors have equal scores
        score = np.concatenate((score, (self.vectors[new] * query).sum(axis=1)))
        best = np.lexsort((at, -score))[:k]
        return at[best], score[best]


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def nearest(embeddings: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the k nearest by inner product of every row
    whose id is divisible by ``every``, nearest first, ties to the smaller id.

    Candidates are all rows but the query's own, all of them indexed.  Rows
    with a null id, and vectors that are null, empty, zero or hold null or
    non-finite components, take no part; neither do vectors of another length
    than the most frequent one (the longer of equals).  Repeated rows of one
    id are one vector (the smallest).  An empty table gives an empty result;
    other columns are ignored.
    """
    v = F.col("__vec")
    rows = embeddings.select(F.col(id_col).cast("long").alias("__id"),
                             F.col(vec_col).cast("array<double>").alias("__vec"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("__id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    rows = materialise(rows.groupBy("__id").agg(F.min("__vec").alias("__vec")), "vectors")
    sizes = rows.groupBy(F.size("__vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim, n = (sizes["dim"], sizes["count"]) if sizes else (1, 0)
    rows = rows.filter(F.size("__vec") == dim)
    is_query = F.col("__id") % every == 0
    n_queries = rows.filter(is_query).count()
    blocks, chunks = -(-n // BLOCK_ROWS) or 1, -(-n_queries // CHUNK_QUERIES) or 1
    part = F.xxhash64("__id")
    members = rows.select(
        F.pmod(part, F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
        "__id", "__vec", F.lit(False).alias("query"))
    asked = rows.filter(is_query).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.pmod(part, F.lit(chunks)).cast("int").alias("chunk"), "__id", "__vec", F.lit(True).alias("query"))

    def search(cell: pa.Table) -> pa.Table:
        query = cell.column("query").to_numpy()
        ids, vectors = cell.column("__id").to_numpy(), _matrix(cell.column("__vec"), dim)
        found = []
        if query.any() and not query.all():
            found = Block(ids[~query], vectors[~query]).search(ids[query], vectors[query], k)
        return pa.table({
            "query_id": np.repeat(ids[query], [len(a) for a, _ in found]) if found else np.zeros(0, np.int64),
            "__id": np.concatenate([a for a, _ in found]) if found else np.zeros(0, np.int64),
            "score": np.concatenate([s for _, s in found]) if found else np.zeros(0)})

    found = with_package(members.unionByName(asked)).groupBy("block", "chunk").applyInArrow(
        search, "query_id long, __id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "__id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("__id").alias(id_col), "score")
