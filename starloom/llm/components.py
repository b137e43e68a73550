"""Connected components of an edge table by alternating large-star and
small-star steps (Kiveris et al., "Connected Components in MapReduce and
Beyond").  Nodes are longs; edges and components stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup_groups, materialise


def _star(edges: DataFrame, count: int, large: bool) -> DataFrame:
    """One step over stored edges (u > v).  Large star: the larger neighbours
    of a node connect to its smallest one; small star: so do the smaller ones
    and the node itself.  The smallest neighbour is an aggregate of one row a
    node, and heavy nodes are looked up without gathering their edges."""
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    near = edges.unionByName(back) if large else edges
    low = materialise(near.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("deg")), "star", 2 * count)
    n = low.agg(F.sum("deg")).first()[0] or 0
    with_low = lookup_groups(near, low, "u", "deg", n, F.col("v"))
    m = F.least("u", "m")
    if large:
        out = with_low.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), m.alias("v"))
    else:
        out = with_low.select(F.explode(F.array(F.struct(F.col("v").alias("u"), m.alias("v")),
                                                F.struct(F.col("u"), m.alias("v")))).alias("e")).select("e.*")
    return out.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root): every node with an edge that is not its component's smallest
    node, with that smallest node.  ``edges`` has longs (u, v) in any order;
    loops and repeats are allowed, no edges give no rows."""
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    e = materialise(e, "edges")
    seen = None
    while True:
        state = e.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if state == seen or state[0] == 0:
            return e.withColumnRenamed("v", "root")
        seen = state
        n = state[0]  # a step gives two edges for each at most
        e = materialise(_star(e, n, True), "large", 2 * n)
        e = materialise(_star(e, 2 * n, False), "small", 2 * n)
