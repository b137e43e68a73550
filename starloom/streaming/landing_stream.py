"""Incremental landing-folder ingestion with Structured Streaming.

The file stream source records in its checkpoint which files it has already
processed, so each run picks up only files delivered since the last one --
the streaming form of "move the file to processed/ after loading".  A run
uses ``trigger(availableNow=True)``: it processes everything available (in
as many micro-batches as ``maxFilesPerTrigger`` asks for) and stops, so it
can be scheduled like a batch job.  The sink is a file sink whose own log
makes each micro-batch's output visible exactly once, also when a run is
retried after a failure.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from starloom.sinks.storage import is_missing


def stream_landing(spark: SparkSession, source_glob: str, schema: StructType, sink_dir: str,
                   checkpoint: str, *, sep: str = ",", header: bool = True,
                   fmt: str = "parquet", max_files_per_trigger: int | None = None) -> int:
    """Append every not-yet-processed delimited file matching ``source_glob``
    to ``sink_dir``; returns the number of rows this run added.  A malformed
    row fails the run, as in the batch load, and its file stays unprocessed."""
    before = _rows(spark, sink_dir, schema, fmt)
    reader = (spark.readStream.schema(schema)
              .option("header", str(header).lower())
              .option("sep", sep)
              .option("mode", "FAILFAST"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    q = (reader.csv(source_glob)
         .writeStream.format(fmt)
         .option("checkpointLocation", checkpoint)
         .outputMode("append")
         .trigger(availableNow=True)
         .start(sink_dir))
    q.awaitTermination()
    return _rows(spark, sink_dir, schema, fmt) - before


def _rows(spark: SparkSession, sink_dir: str, schema: StructType, fmt: str) -> int:
    """Rows in the sink (Parquet counts them from its footers)."""
    try:
        return spark.read.format(fmt).schema(schema).load(sink_dir).count()
    except AnalysisException as e:
        if is_missing(e):
            return 0
        raise
