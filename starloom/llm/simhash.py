"""SimHash near-duplicates by anchor points of a covering code.

A fingerprint has 64 bits; two link at ``max_bits`` differing bits or fewer.
Anchors are the codewords of a perfect code over some of the bits: every
fingerprint lies within the covering radius of its nearest anchor, its home.
A fingerprint y that links to x differs from it in ``max_bits`` at most, so it
lies within radius + ``max_bits`` of x's home.  Each fingerprint is therefore
replicated to every anchor within that distance, and each anchor compares the
fingerprints at home there with all that visit: no link is lost, whichever
code is chosen.

The codes are perfect ones: the binary Golay code (23 bits, radius 3) and
Hamming codes (7 or 31 bits, radius 1), alone or side by side; with several
blocks the distance beyond the radii is what a visitor spends of ``max_bits``.
A plan covers the whole fingerprint once, or each half of it with half of
``max_bits``: links differ by no more than that in one of the halves, so far
fewer anchors are within reach.  More distinct fingerprints call for more
anchors with smaller groups, at the price of more replicas; ``choose_plan``
takes the cheapest by estimate.

Copies of a fingerprint are one class before anything is compared.  An anchor
with many members is cut into cells of bounded size; a cell returns a spanning
forest of its links, never all pairs.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .common import lookup_groups, materialise, positional, with_package
from .components import components

#: (bits, generator polynomial, radius) of the perfect codes (fixed values).
GOLAY = (23, 0b101011100011, 3)
HAMMING = (7, 0b1011, 1)
LONG_HAMMING = (31, 0b100101, 1)
#: Codes over the low bits of a fingerprint.
CODES = ((GOLAY,), (GOLAY, HAMMING), (GOLAY, HAMMING, HAMMING), (GOLAY, GOLAY))
#: Plans: (first bit, code) of each part that is looked at.
PLANS = tuple(((0, code),) for code in CODES) + tuple(
    ((0, code), (32, code)) for code in ((GOLAY,), (GOLAY, HAMMING), (LONG_HAMMING,)))
#: Most homes and most visitors that one task compares at once.
CELL_HOMES, CELL_VISITORS = 1 << 13, 1 << 15
#: Rows to drop, known by two numbers each, that are broadcast.
MAX_BROADCAST_DROPS = 1 << 18
#: Fingerprints that one task replicates.
TASK_FINGERPRINTS = 1 << 14


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of a text's word shingles as a signed 64-bit integer.

    A-Z are lower-cased, words are split at ASCII white space; fewer words than
    ``shingle`` make one shingle, none make fingerprint 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
        hashes = np.array([xxhash.xxh64_intdigest(grams[0], 42)], dtype=np.uint64)
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in
                              zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())),
                             np.uint64, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):  # bounded memory for long texts
        bits = np.unpackbits(hashes[at:at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(packed.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(__id, __fp), one row per row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["__id", "__fp"])

    slim = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return with_package(slim).mapInArrow(run, f"__id {slim.dtypes[0][1]}, __fp long")


@functools.cache
def _coset_table(code: tuple[int, int, int], most: int) -> list[list[np.ndarray]]:
    """For a perfect code, table[syndrome][cost]: the difference vectors from a
    point of that syndrome to the codewords, by their weight beyond the radius
    (``most`` at most)."""
    n, gen, radius = code
    redundancy = gen.bit_length() - 1
    table = [[[] for _ in range(most + 1)] for _ in range(1 << redundancy)]
    for weight in range(min(n, radius + most) + 1):
        some = list(itertools.combinations(range(n), weight))
        places = np.array(some, np.uint64).reshape(len(some), weight)
        diff = (np.uint64(1) << places).sum(axis=1, dtype=np.uint64)
        syndrome = _syndrome(diff, code).astype(np.int64)
        order = np.argsort(syndrome, kind="stable")
        ends = np.cumsum(np.bincount(syndrome, minlength=len(table)))
        for s, some in enumerate(np.split(diff[order], ends[:-1])):
            table[s][max(weight - radius, 0)].append(some)
    return [[np.concatenate(c) if c else np.zeros(0, np.uint64) for c in row] for row in table]


def _syndrome(v: np.ndarray, code: tuple[int, int, int]) -> np.ndarray:
    """Remainder of each bit vector by the code's generator polynomial."""
    n, gen, _ = code
    redundancy = gen.bit_length() - 1
    r = v.astype(np.uint64)
    for i in range(n - 1, redundancy - 1, -1):
        r = r ^ np.where((r >> np.uint64(i)) & np.uint64(1), np.uint64(gen << (i - redundancy)), np.uint64(0))
    return r


def replicas(fp: np.ndarray, blocks: tuple, max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of fp, anchor, is_home) for each anchor within reach."""
    at, anchor, cost = np.arange(len(fp)), np.zeros(len(fp), np.uint64), np.zeros(len(fp), np.int64)
    shift = 0
    for code in blocks:
        n = code[0]
        part = (fp >> np.uint64(shift)) & np.uint64((1 << n) - 1)
        syn = _syndrome(part, code).astype(np.int64)
        table = _coset_table(code, max_bits)
        nxt = []
        # rows of one syndrome and cost so far get the same differences
        group = syn[at] * (max_bits + 1) + cost
        order = np.argsort(group, kind="stable")
        cuts = np.flatnonzero(np.diff(group[order])) + 1
        for rows in np.split(order, cuts):
            if not len(rows):
                continue
            s, spent = divmod(int(group[rows[0]]), max_bits + 1)
            for c in range(min(max_bits - spent, len(table[s]) - 1) + 1):
                diff = table[s][c]
                if len(diff):
                    a = (part[at[rows]][:, None] ^ diff[None, :]) << np.uint64(shift)
                    nxt.append((np.repeat(at[rows], len(diff)), (anchor[rows][:, None] | a).ravel(),
                                np.full(len(rows) * len(diff), spent + c)))
        at, anchor, cost = (np.concatenate(x) for x in zip(*nxt)) if nxt else (at, anchor, cost)
        shift += n
    return at, anchor, cost == 0


def plan_replicas(fp: np.ndarray, plan: tuple, max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``replicas`` of every part of a plan; anchors tell the parts apart."""
    found = []
    for part, (shift, code) in enumerate(plan):
        at, anchor, home = replicas(fp >> np.uint64(shift), code, max_bits // len(plan))
        found.append((at, anchor | np.uint64(part << 60), home))
    return tuple(np.concatenate(x) for x in zip(*found))


@functools.cache
def reach(plan: tuple, max_bits: int) -> tuple[tuple[float, int], ...]:
    """For each part of a plan (anchors that a random fingerprint goes to, anchors in all)."""
    sample = np.random.default_rng(1).integers(0, 1 << 63, 64, dtype=np.uint64)
    return tuple((len(replicas(sample, code, max_bits // len(plan))[0]) / 64,
                  2 ** sum(n - g.bit_length() + 1 for n, g, _ in code)) for _, code in plan)


def choose_plan(distinct: int, max_bits: int) -> tuple:
    """The plan of least estimated work in comparisons: a replica costs about
    100, an anchor in use 300,000.  Results are the same with any of them."""
    def work(plan):
        return sum(distinct * visits * 100 + distinct * distinct * visits / anchors + min(anchors, distinct) * 3e5
                   for visits, anchors in reach(plan, max_bits))
    return min(PLANS, key=work)


def spanning_forest(homes: np.ndarray, visitors: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smaller node) that connect whatever the links between
    ``homes`` and ``visitors`` connect: at most one per node."""
    nodes = np.unique(np.concatenate((homes, visitors)))
    label = np.arange(len(nodes))
    h_at, v_at = np.searchsorted(nodes, homes), np.searchsorted(nodes, visitors)
    step = max(1, (1 << 22) // max(1, len(visitors)))
    near = []
    for i in range(0, len(homes), step):  # a bounded block of the comparison at a time
        d = np.bitwise_count(homes[i:i + step, None] ^ visitors[None, :])
        a, b = np.nonzero(d <= max_bits)
        u, v = h_at[i:i + step][a], v_at[b]
        other = u != v
        u, v = u[other], v[other]
        if len(u):
            _merge(label, u, v)
            near.append(True)
    if not near:
        return nodes[:0], nodes[:0]
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _merge(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Union the ends of the edges: label[i] becomes the smallest index connected."""
    while True:
        a, b = label[u], label[v]
        if (a == b).all():
            return
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(label, high, low)
        while True:  # point every node at its root
            root = label[label]
            if (root == label).all():
                break
            label[:] = root


def _replicate(plan: tuple, max_bits: int):
    """Fingerprints to rows (anchor, homes, visitors): packed fingerprints of
    one batch that go to one anchor, and their numbers."""
    per = max(1, int(400_000 / sum(visits for visits, _ in reach(plan, max_bits))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # as many fingerprints at once as memory allows: fewer and larger pieces
        held, n = [], 0
        for b in batches:
            held.append(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            n += b.num_rows
            if n >= per:
                yield from pieces(np.concatenate(held))
                held, n = [], 0
        if n:
            yield from pieces(np.concatenate(held))

    def pieces(every: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(every), per):
            fp = every[i:i + per]
            at, anchor, home = plan_replicas(fp, plan, max_bits)
            order = np.argsort(anchor, kind="stable")
            at, anchor, home = at[order], anchor[order], home[order]
            first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
            ends = np.append(first[1:], len(anchor))
            visitors, n_home = fp[at], np.add.reduceat(home, first)
            homes, h_end = visitors[home], np.cumsum(n_home)
            v_bytes, h_bytes = visitors.tobytes(), homes.tobytes()
            yield pa.RecordBatch.from_arrays([
                pa.array(anchor[first].view(np.int64)),
                pa.array([h_bytes[8 * (e - n):8 * e] for n, e in zip(n_home.tolist(), h_end.tolist())], pa.binary()),
                pa.array([v_bytes[8 * s:8 * e] for s, e in zip(first.tolist(), ends.tolist())], pa.binary()),
                pa.array(n_home.astype(np.int64)), pa.array((ends - first).astype(np.int64))],
                ["anchor", "homes", "visitors", "n_homes", "n_visitors"])
    return run


def _compare(max_bits: int):
    def run(cell: pa.Table) -> pa.Table:
        homes, visitors = (np.frombuffer(b"".join(x for x in cell.column(c).to_pylist() if x), np.uint64)
                           for c in ("homes", "visitors"))
        u, v = spanning_forest(homes, visitors, max_bits)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})
    return run


def links(classes: DataFrame, distinct: int, max_bits: int) -> DataFrame:
    """(u, v): edges that connect what fingerprints at ``max_bits`` or fewer
    differing bits connect.  ``classes`` has one row per fingerprint (__fp)."""
    plan = choose_plan(distinct, max_bits)
    # replicas are many and costly: spread the fingerprints over tasks first
    spread = with_package(classes).select("__fp").repartition(-(-distinct // TASK_FINGERPRINTS) or 1)
    sent = materialise(spread.mapInArrow(
        _replicate(plan, max_bits),
        "anchor long, homes binary, visitors binary, n_homes long, n_visitors long"), "anchors")
    counts = materialise(sent.groupBy("anchor").agg(
        F.ceil(F.sum("n_homes") / CELL_HOMES).alias("rows"), F.ceil(F.sum("n_visitors") / CELL_VISITORS).alias("cols"),
        F.count("*").alias("pieces")).filter("rows > 0"), "cells", distinct)
    pieces = lookup_groups(sent, counts, "anchor", "pieces", sent.count(), F.xxhash64("homes", "visitors"))
    pieces = pieces.filter(F.col("rows").isNotNull())
    slot = F.xxhash64("visitors")
    one = F.lit(1).cast("long")
    no = F.lit(None).cast("binary")
    homes = pieces.filter("n_homes > 0").select(
        "anchor", F.pmod(slot, "rows").alias("i"), F.explode(F.sequence(one, "cols")).alias("j"),
        "homes", no.alias("visitors"))
    visitors = pieces.select(
        "anchor", F.explode(F.sequence(one, "rows")).alias("i"), F.pmod(slot, "cols").alias("j"),
        no.alias("homes"), "visitors")
    cells = homes.withColumn("i", F.col("i") + 1).unionByName(visitors.withColumn("j", F.col("j") + 1))
    return with_package(cells).groupBy("anchor", "i", "j").applyInArrow(_compare(max_bits), "u long, v long")


def simhash_groups(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (id, fingerprint, component_id).

    ``fingerprint`` has 16 lower-case hex digits; ``component_id`` is the
    smallest id that links of at most ``max_bits`` differing bits reach, the
    row's own included.  Null and empty texts, and texts of white space only,
    have fingerprint zero and link like any other.  Null ids are never the
    smallest (null where a component has no other).  Repeated rows share a
    component.  Texts are hashed whole, however long.  An empty table gives an
    empty result; other columns are ignored.
    """
    fps = materialise(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    n = fps.count()
    classes = materialise(fps.groupBy("__fp").agg(F.min("__id").alias("__rep"), F.count("*").alias("__rows")),
                          "classes", n)
    distinct = classes.count()
    roots = components(links(classes, distinct, max_bits))
    classes = classes.join(roots, classes["__fp"] == roots["u"], "left").select(
        "__fp", "__rep", "__rows", F.coalesce("root", "__fp").alias("__root"))
    classes = materialise(classes, "rooted", distinct)
    least = materialise(classes.groupBy("__root").agg(
        F.min("__rep").alias("component_id"), F.count("*").alias("__members")), "least", distinct)
    named = lookup_groups(classes, least, "__root", "__members", distinct, F.col("__fp"))
    named = materialise(named.select("__fp", "__rows", "component_id"), "components", distinct)
    out = lookup_groups(fps, named, "__fp", "__rows", n, F.col("__id"))
    return out.select(F.col("__id").alias(id_col), F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"),
                      "component_id")


def keep_one_each(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id.

    All columns stay.  A row is known by its id and text, so rows that share an
    id leave only with their own group.  Among texts of the smallest id, and in
    groups of null ids only, the smallest hash of the text stays; null ids are
    never the smallest.  Rows equal in id and text can't be told apart and stay
    or leave together.
    """
    rows, (key, text) = positional(docs, id_col, text_col)
    digest = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    known = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), digest.alias("text"))
    groups = simhash_groups(rows.select(known.alias("known"), F.col(text).alias("text")), shingle, max_bits, "known", "text")
    drop = materialise(groups.filter(F.col("known") != F.col("component_id")).select(
        F.col("known.id").alias("__drop"), F.col("known.text").alias("__digest")).distinct(), "drop")
    if isinstance(drop.schema["__drop"].dataType, NumericType) and drop.count() <= MAX_BROADCAST_DROPS:
        drop = F.broadcast(drop)  # two numbers a row: no text has to move
    return rows.join(drop, (digest == F.col("__digest")) & F.col(key).eqNullSafe(F.col("__drop")),
                     "left_anti").toDF(*docs.columns)
