"""Load profiles: rows, NULLs and distinct values per column of a load,
measured while the load is written.

The metrics are aggregates observed in the write's own pass.  Distinct values
are HyperLogLog sketches, so profiles of several loads merge into one of all of
them without reading any load again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

PROFILE_SCHEMA = "load string, column string, rows long, nulls long, sketch binary"
#: log2 of a sketch's registers: 2^12 of them give a standard error of 1.6%.
SKETCH_BITS = 12


def _hashable(field) -> F.Column:
    """A value as text that is equal for equal values."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (ArrayType, MapType, StructType)):
        return F.when(c.isNotNull(), F.to_json(F.struct(c)))
    return c.cast("string")


def profiled_write(df: DataFrame, load: str, write: Callable[[DataFrame], object]) -> DataFrame:
    """Run ``write`` on ``df`` and return the load's profile, one row per
    column.  ``write`` must read its input once."""
    obs = Observation(f"profile_{uuid.uuid4().hex[:8]}")
    metrics = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(df.schema.fields):
        metrics.append(F.count(F.when(F.col(f"`{f.name}`").isNull(), 1)).alias(f"nulls_{i}"))
        metrics.append(F.hll_sketch_agg(_hashable(f), SKETCH_BITS).alias(f"sketch_{i}"))
    write(df.observe(obs, *metrics))
    got = obs.get
    rows = [(load, f.name, got["rows"], got[f"nulls_{i}"], got[f"sketch_{i}"]) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, PROFILE_SCHEMA)


def store_profile(profile: DataFrame, path: str) -> None:
    """Add a load's profile to the profile table at ``path``."""
    profile.coalesce(1).write.mode("append").parquet(path)


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROFILE_SCHEMA).parquet(path)


def merge_profiles(profiles: DataFrame, by: tuple[str, ...] = ("column",)) -> DataFrame:
    """(column, loads, rows, nulls, distinct_estimate) over all loads in ``profiles``."""
    return profiles.groupBy(*by).agg(
        F.count_distinct("load").alias("loads"), F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"))
