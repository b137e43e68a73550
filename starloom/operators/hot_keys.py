"""Key lookups under hot foreign keys.

A frequent-item sketch (``approx_top_k``, mergeable over tasks and loads) finds
the keys that a large share of the fact's rows have.  Those rows meet their few
dimension rows by a broadcast, wherever they are; only the others shuffle.  The
sketch over- and undercounts, but a key that it misses or adds costs time only:
each row is looked up once, by one of the two ways.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.keys import Lookup, lookup_keys

#: No more keys than this are hot, and so no more dimension rows broadcast.
MAX_HOT_KEYS = 256
#: Counters of the sketch: a key with more than 3.5 / counters of all rows is found.
COUNTERS = 4096
#: Share of all rows from which a key is hot.
HOT_SHARE = 0.01


def key_sketch(fact: DataFrame, key: str, counters: int = COUNTERS) -> DataFrame:
    """(sketch, n): one row, the key's frequent items and the number of keys.
    Sketches of several loads are put together by ``merge_sketches``."""
    return fact.select(F.col(key).alias("k")).where("k IS NOT NULL").agg(
        F.expr(f"approx_top_k_accumulate(k, {counters})").alias("sketch"), F.count("k").alias("n"))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One (sketch, n) for the rows of all of them."""
    return sketches.where("n > 0").agg(F.expr("approx_top_k_combine(sketch)").alias("sketch"), F.sum("n").alias("n"))


def hot_keys(sketch: DataFrame, share: float = HOT_SHARE, most: int = MAX_HOT_KEYS) -> list:
    """The keys, ``most`` at most, that about ``share`` or more of the rows have."""
    top = sketch.where("n > 0").select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {most})")).alias("i"), "n")
    return [r[0] for r in top.where(F.col("i.count") >= share * F.col("n")).select("i.item").collect()]


def lookup_hot(fact: DataFrame, lookup: Lookup, hot: list | None = None) -> DataFrame:
    """``lookup_keys`` for one single-column lookup, without a shuffle of the
    rows with hot keys.  ``hot`` is found from the fact unless given (from a
    sketch of earlier loads).  Every fact row is kept once; a key that the
    dimension holds twice raises, as there."""
    (key, natural), = lookup.on.items()
    if hot is None:
        hot = hot_keys(key_sketch(fact, key))
    if not hot:
        return lookup_keys(fact, [lookup])
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    few = lookup.dim.where(F.col(natural).isin(hot))
    # at most MAX_HOT_KEYS rows, as each key is there once
    served = lookup_keys(fact.where(is_hot), [Lookup(few, lookup.on, lookup.take, lookup.replace, lookup.unique)],
                         broadcast=True)
    rest = lookup_keys(fact.where(~is_hot), [lookup])
    return served.unionByName(rest)
