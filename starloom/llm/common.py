"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: No more than this many groups are ever broadcast as "heavy".
MAX_HEAVY_GROUPS = 8192
#: Smaller groups are never heavy.
MIN_HEAVY_ROWS = 64


_stored: list[str] = []


#: Rows of a stored file, where the number of rows is known beforehand.
FILE_ROWS = 100_000


def materialise(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the session's checkpoint folder and read
    it back: lineage ends at files that every executor sees, so a lost
    executor costs no more than its running tasks.

    ``rows``, a bound on the rows of a result of cheap last steps, keeps a
    small table from being written as many tiny files."""
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(-(-rows // FILE_ROWS) or 1)
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _stored.append(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_tables() -> int:
    """How many tables this process has stored and not discarded."""
    return len(_stored)


def discard_stored(spark: SparkSession, first: int, last: int) -> None:
    """Delete the stored tables from number ``first`` up to, not including,
    ``last``.  Only for a caller that knows that no result reads them any
    more, as a pipeline does of a stage whose output is written."""
    sc = spark.sparkContext
    for path in _stored[first:last]:
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
    del _stored[first:last]


def heavy_threshold(total_rows: int) -> int:
    """Group size from which a group counts as heavy: at most
    ``MAX_HEAVY_GROUPS`` groups can be that large, whatever the data."""
    return max(MIN_HEAVY_ROWS, -(-total_rows // MAX_HEAVY_GROUPS))


def lookup_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total_rows: int,
                  spread: Column, max_broadcast: int | None = None) -> DataFrame:
    """Left join of ``rows`` to ``groups`` (one row per non-null ``key``), safe
    under hot keys.

    Up to ``max_broadcast`` groups (counted first; 8,192 unless given) are
    broadcast whole and nothing shuffles.  Beyond that, groups of ``heavy_threshold`` rows or more -- at most 8,192 of them, by
    count -- are broadcast; the remaining keys, each with few rows, meet by a
    shuffle join.  Rows already served get a ``spread`` key there, so a hot
    key never lands in one task.  ``groups`` should be a stored table: it is
    read twice.
    """
    cols = [c for c in groups.columns if c != key]
    if groups.count() <= (MAX_HEAVY_GROUPS if max_broadcast is None else max_broadcast):
        small = groups.withColumnRenamed(key, "__hk")
        return (rows.join(F.broadcast(small), rows[key] == F.col("__hk"), "left")
                .select(*rows.columns, *[small[c] for c in cols]))
    at = heavy_threshold(total_rows)
    heavy = groups.filter(F.col(size) >= at).select(
        F.col(key).alias("__hk"), F.struct(*cols).alias("__heavy"))
    light = groups.filter(F.col(size) < at).select(
        F.col(key).cast("string").alias("__lk"), F.struct(*cols).alias("__light"))
    served = rows.join(F.broadcast(heavy), rows[key] == F.col("__hk"), "left")
    served = served.withColumn(
        "__sk", F.when(F.col("__heavy").isNull() & F.col(key).isNotNull(), F.col(key).cast("string"))
        .otherwise(F.concat(F.lit("~"), F.coalesce(spread.cast("string"), F.lit("")))))
    out = served.join(light, F.col("__sk") == F.col("__lk"), "left")
    got = F.coalesce(F.col("__heavy"), F.col("__light"))
    return out.select(*rows.columns, *[got[c].alias(c) for c in cols])


def positional(df: DataFrame, *cols: str) -> tuple[DataFrame, list[str]]:
    """``df`` with columns named by position, so that none clashes with an
    operator's own, and the new names of ``cols``; ``toDF`` undoes it."""
    names = [f"__c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), [names[df.columns.index(c)] for c in cols]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Path of a public vocabulary file; every executor has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


_shipped: set[str] = set()


#: Rows of an Arrow batch: whole texts, of which the default of 10,000 rows
#: would hold hundreds of MB in an executor and its Python workers.
ARROW_ROWS = 1000
_ARROW_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def with_package(df: DataFrame) -> DataFrame:
    """``df``, after sending this package to the executors, so that functions
    run there whether or not it is installed; once per application.  Arrow
    batches get ``ARROW_ROWS`` rows unless the session has another setting."""
    sc, conf = df.sparkSession.sparkContext, df.sparkSession.conf
    if conf.get(_ARROW_CONF) == "10000":
        conf.set(_ARROW_CONF, str(ARROW_ROWS))
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        archive = Path(tempfile.mkdtemp(prefix="starloom-package-")) / "starloom.zip"  # Spark serves it from the driver
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted((root / "starloom").rglob("*.py")):
                z.write(f, f.relative_to(root))
        sc.addPyFile(str(archive))
        _shipped.add(sc.applicationId)
    return df
