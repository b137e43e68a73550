"""Streaming upsert: landed files merged into a versioned type-1 dimension.

Each micro-batch becomes one new version of the dimension, and the version log
records which batch of which stream it holds, in the same commit.  Spark hands
a batch out again if the process ended between that commit and the stream's own
checkpoint; a batch that is already recorded changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.operators.scd1 import scd1_merge
from starloom.sinks.versions import has_note, read_current_or_none, write_version


def newest_per_key(batch: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the largest by ``order_by``, then by the other columns.
    A grouped maximum, so that a hot key is one row per task in the shuffle."""
    rest = [c for c in batch.columns if c not in keys]
    order = [*order_by, *[c for c in rest if c not in order_by]]
    row = F.max(F.struct(*[F.col(c) for c in order])).alias("_row")
    return batch.groupBy(*keys).agg(row).select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def upsert_batch(batch: DataFrame, batch_id: int, base: str, keys: Sequence[str], target_schema: StructType, *,
                 stream: str = "stream", order_by: Sequence[str] = (), **merge) -> bool:
    """Merge one micro-batch into the dimension at ``base`` as a new version.
    Returns False, with nothing changed, for a batch that was merged before or
    has no rows.  Further arguments are those of ``scd1_merge``."""
    spark, note = batch.sparkSession, f"{stream}/{batch_id}"
    if has_note(spark, base, note) or batch.isEmpty():
        return False
    target = read_current_or_none(spark, base)
    if target is None:
        target = spark.createDataFrame([], target_schema)
    known = batch.where(F.coalesce(*[F.col(k).cast("string") for k in keys]).isNotNull())
    source = newest_per_key(known, keys, order_by)
    source = source.select(*[c for c in source.columns if c in target.columns])
    write_version(scd1_merge(target, source, keys, **merge), base, note=note)
    return True


def stream_upsert(spark: SparkSession, source_glob: str, schema: StructType, base: str, keys: Sequence[str],
                  target_schema: StructType, checkpoint: str, *, stream: str = "stream", sep: str = ",",
                  header: bool = True, order_by: Sequence[str] = (), max_files_per_trigger: int | None = None,
                  **merge) -> int:
    """Merge every not-yet-processed delimited file matching ``source_glob``
    into the dimension at ``base``; returns how many batches changed it.  A
    malformed row fails the run, and its files stay unprocessed."""
    reader = (spark.readStream.schema(schema).option("header", str(header).lower()).option("sep", sep)
              .option("mode", "FAILFAST"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    changed = []

    def merge_one(batch: DataFrame, batch_id: int) -> None:
        if upsert_batch(batch, batch_id, base, keys, target_schema, stream=stream, order_by=order_by, **merge):
            changed.append(batch_id)

    q = (reader.csv(source_glob).writeStream.foreachBatch(merge_one).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(changed)
