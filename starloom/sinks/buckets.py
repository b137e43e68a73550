"""Bucketed tables, for chains of joins on one key without exchanges.

Tables written with the same keys and number of buckets join bucket by bucket,
already sorted: however many of them are left-joined, no row is shuffled.  The
cost is one shuffle per table when it is written.  This suits tables that are
joined often and whose keys repeat little: all rows of a key share a bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from starloom.session import scratch_dir


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Store ``df`` as the catalog table ``name``, one sorted file per bucket,
    and read it back.  Its files are in ``path`` (default: a folder on the
    session's shared storage)."""
    keys = list(keys)
    spark = df.sparkSession
    path = path or scratch_dir(spark, f"bucketed-{name}")
    # the same hash deals rows to tasks and to buckets, so each task writes one file
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite")
     .option("path", path).saveAsTable(name))
    return spark.table(name)


def bucket_count(spark: SparkSession, table_bytes: int, bucket_bytes: int = 256 << 20) -> int:
    """Buckets for a table of that size: a power of two, so that tables of
    other sizes can share it, and no fewer than the session's shuffle tasks.
    Never more than the session allows a table; from there on buckets grow."""
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-table_bytes // bucket_bytes), 1)
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return 1 << min((least - 1).bit_length(), most.bit_length() - 1)
