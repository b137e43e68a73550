"""Incremental child roll-ups: additive state instead of a rescan.

The state of a parent key is what its counts, sums and means are made of: the
rows, the values that are not NULL, their sum, and the sum of the values as the
decimals that the mean is taken over.  States add up, so new child rows are
rolled up alone and added, and withdrawn ones subtracted; the result equals the
roll-up of all rows (``rollup_children``).

Stored state is partitioned by a bucket of the key, and a delta rewrites only
the buckets it touches.  Bucket by what a delivery has in common (a race, a
month) where there is such a column; the default, a hash of the key, spreads a
delivery over all buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import scratch_dir
from starloom.sinks.versions import (
    drop_folder,
    has_note,
    read_current,
    read_current_or_none,
    replace_partitions,
    write_version,
)

BUCKET = "_bucket"
STATE = ("_rows", "_values", "_sum", "_decimal_sum")


def rollup_state(child: DataFrame, keys: Sequence[str], value_col: str | Column, *,
                 avg_input_type: str = "decimal(10,0)", bucket: Column | None = None, buckets: int = 64,
                 withdrawn: Column | None = None) -> DataFrame:
    """The state of ``child`` per key: ``keys``, a bucket and the sums.  Rows
    for which ``withdrawn`` is true count against it.  Aggregation is partial
    before the shuffle, so a hot parent key is one row per task there."""
    keys = list(keys)
    v = F.col(value_col) if isinstance(value_col, str) else value_col
    sign = F.lit(1) if withdrawn is None else F.when(withdrawn, F.lit(-1)).otherwise(F.lit(1))
    where = bucket if bucket is not None else F.pmod(F.xxhash64(*keys), F.lit(buckets))
    rows = child.select(*keys, where.cast("int").alias(BUCKET), sign.alias("_sign"), v.alias("_v"),
                        v.cast(avg_input_type).cast("decimal(38,4)").alias("_d"))
    return rows.groupBy(*keys, BUCKET).agg(
        F.sum("_sign").cast("bigint").alias("_rows"),
        F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), F.col("_sign"))), F.lit(0)).cast("bigint").alias("_values"),
        F.coalesce(F.sum(F.col("_v") * F.col("_sign")), F.lit(0)).cast("decimal(38,4)").alias("_sum"),
        F.coalesce(F.sum(F.col("_d") * F.col("_sign")), F.lit(0)).cast("decimal(38,4)").alias("_decimal_sum"))


def merge_states(one: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state of both inputs together; a key without rows left has none."""
    both = one.unionByName(other.select(*one.columns))
    out = both.groupBy(*keys, BUCKET).agg(*[F.sum(c).cast(dict(one.dtypes)[c]).alias(c) for c in STATE])
    return out.where(F.col("_rows") != 0)


def finish_rollup(state: DataFrame, keys: Sequence[str], *, count_name: str = "child_count",
                  sum_name: str | None = "child_total", avg_name: str | None = "child_avg",
                  sum_type: str = "bigint", avg_scale_type: str = "decimal(14,4)",
                  avg_type: str = "decimal(8,1)") -> DataFrame:
    """Counts, sums and means from a state, as ``rollup_children`` gives them;
    sum and mean are NULL where every value is."""
    some = F.col("_values") != 0
    cols = [F.col("_rows").alias(count_name)]
    if sum_name:
        cols.append(F.when(some, F.col("_sum")).cast(sum_type).alias(sum_name))
    if avg_name:
        mean = (F.col("_decimal_sum") / F.col("_values")).cast(avg_scale_type)
        cols.append(F.when(some, mean).cast(avg_type).alias(avg_name))
    return state.select(*keys, *cols)


def apply_delta(spark: SparkSession, base: str, delta: DataFrame, keys: Sequence[str], delivery: str | None = None) -> bool:
    """Add a delta's state to the one stored at ``base``, rewriting only the
    buckets that the delta has.  A ``delivery`` of a name that was added before
    changes nothing and returns False."""
    if delivery is not None and has_note(spark, base, delivery):
        return False
    stored = read_current_or_none(spark, base)
    if stored is None:
        write_version(delta.where(F.col("_rows") != 0), base, partition_by=BUCKET, note=delivery)
        return True
    # read twice below, and small beside the state
    path = scratch_dir(spark, "rollup-delta")
    delta.write.parquet(path)
    delta = spark.read.schema(delta.schema).parquet(path)
    touched = delta.select(BUCKET).distinct()
    # no more buckets than the table has partitions, which reading it lists too; the others' files are pruned
    old = stored.where(F.col(BUCKET).isin([r[0] for r in touched.collect()]))
    replace_partitions(merge_states(old, delta, keys), base, BUCKET, touched, note=delivery)
    drop_folder(spark, path)
    return True


def read_rollup(spark: SparkSession, base: str, keys: Sequence[str], **names) -> DataFrame:
    """The roll-up that the stored state gives."""
    return finish_rollup(read_current(spark, base), keys, **names)
