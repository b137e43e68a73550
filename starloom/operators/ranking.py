"""RANK() within a partition key without putting a whole partition into one
task.

``rank_within`` computes the exact SQL ``RANK() OVER (PARTITION BY by ORDER BY value DESC)``
as prefix sums:

1. distinct ``(by, value)`` pairs with their multiplicity (a grouped count,
   combined map-side, so ties collapse to one row);
2. those pairs range-partitioned on ``(by, value desc)`` and frozen with a
   reliable ``checkpoint()``, so partition boundaries survive recomputation;
3. per (range partition, by): the number of rows -- a small table, one row
   per partition and key -- prefix-summed across partitions for each key;
4. within each range partition a running count of the rows before each
   value;
5. rank = 1 + rows before in earlier partitions + rows before in this one,
   joined back to the rows on ``(by, value)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import checkpoint_dir


def rank_within(df: DataFrame, by: Sequence[str], value: str, rank_name: str = "rank", *,
                descending: bool = True) -> DataFrame:
    """Add ``rank_name`` = RANK() OVER (PARTITION BY by ORDER BY value [DESC])
    as INT.  NULL values rank last, as in Spark's default descending order."""
    by = list(by)
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    checkpoint_dir(df.sparkSession)
    values = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_rk_n"))
    ranged = (values.repartitionByRange(*[F.col(b) for b in by], order)
              .withColumn("_rk_part", F.spark_partition_id())
              .checkpoint(eager=True))
    per_part = ranged.groupBy("_rk_part", *by).agg(F.sum("_rk_n").alias("_rk_part_n"))
    # one row per (range partition, key): bounded by partitions x keys present
    before = per_part.select(
        "_rk_part", *by,
        F.coalesce(F.sum("_rk_part_n").over(
            Window.partitionBy(*by).orderBy("_rk_part")
            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_rk_off"))
    within = (Window.partitionBy("_rk_part", *by).orderBy(order)
              .rowsBetween(Window.unboundedPreceding, -1))
    # NULL is a key of its own in PARTITION BY: join the offsets null-safely
    on = ranged["_rk_part"] == before["_rk_part"]
    for b in by:
        on = on & ranged[b].eqNullSafe(before[b])
    ranks = (ranged.join(before, on).select(ranged["*"], before["_rk_off"])
             .select(*by, value,
                     (F.lit(1) + F.col("_rk_off")
                      + F.coalesce(F.sum("_rk_n").over(within), F.lit(0))).cast("int").alias(rank_name)))
    # NULL keys or values never match in an equi-join: compare null-safely
    cond = None
    for c in by + [value]:
        eq = df[c].eqNullSafe(ranks[c])
        cond = eq if cond is None else cond & eq
    out = df.join(ranks, cond, "left")
    for c in by + [value]:
        out = out.drop(ranks[c])
    return out
