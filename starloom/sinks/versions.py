"""Versioned tables: a version is a set of folders, and a log says which.

Plain Parquet offers no atomic replace and Spark refuses to overwrite a path
that the same plan reads.  Every load therefore writes folders of its own and
only then appends the new version to the table's log, as one file; readers take
the newest logged version.  A failed load leaves the previous version current
(the fact of a truncate-reload is never seen empty).

As a version is a set of folders, a load needs to write only what it changes:

* ``write_version`` writes the whole table;
* ``append_version`` writes new rows beside the folders of the current version;
* ``replace_partitions`` writes the named partitions of a partitioned table;
  the others' folders are taken over, those left without rows disappear.

``remove_superseded`` deletes folders that no kept version refers to, sparing
what a registered reader (``reading``) uses.  A table has one writer at a time.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, StringType, StructField, StructType

from starloom.sinks.storage import is_missing, write_table

LOG_SCHEMA = ("version long, path string, format string, partition string, schema string, written_at long, "
              "note string")
READER_SCHEMA = "reader string, version long, until long"
#: The column that a partition folder's version is read as; never in a result.
_VERSION_DIR = "_version"


def _root(base: str) -> str:
    return base.rstrip("/")


def version_log(spark: SparkSession, base: str) -> DataFrame:
    """The table's log: one row per folder of each version (``path`` NULL for
    a version without any)."""
    return spark.read.schema(LOG_SCHEMA).parquet(f"{_root(base)}/versions")


def _log_or_none(spark: SparkSession, base: str) -> DataFrame | None:
    try:
        return version_log(spark, base)
    except AnalysisException as e:
        if is_missing(e):
            return None
        raise


def _at(log: DataFrame, version: int | None = None) -> DataFrame:
    """The rows of a version, the newest unless one is given."""
    if version is not None:
        return log.where(F.col("version") == version)
    return log.where(F.col("version") == log.agg(F.max("version")).scalar())


def current_version(spark: SparkSession, base: str) -> int:
    """The newest version's number, 0 for a table that was never written."""
    log = _log_or_none(spark, base)
    return 0 if log is None else log.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def _commit(rows: DataFrame, base: str) -> None:
    """Make a version current: its log rows become visible as one file."""
    rows.coalesce(1).write.mode("append").parquet(f"{_root(base)}/versions")


def _entry(spark: SparkSession, version: int, path: str | None, fmt: str, schema: StructType,
           note: str | None = None) -> DataFrame:
    return spark.createDataFrame([(version, path, fmt, None, schema.json(), time.time_ns(), note)], LOG_SCHEMA)


def has_note(spark: SparkSession, base: str, note: str) -> bool:
    """Whether a version of the table was written with ``note``: the name of
    the delivery that it holds, recorded in the same commit."""
    log = _log_or_none(spark, base)
    return log is not None and log.where(F.col("note") == note).limit(1).count() > 0


def _new_folder(base: str, version: int) -> str:
    # a failed load may have left a folder of this number
    return f"{_root(base)}/data/{_VERSION_DIR}={version}-{uuid.uuid4().hex[:8]}"


def write_version(df: DataFrame, base: str, *, fmt: str = "parquet", partition_by: str | None = None,
                  note: str | None = None) -> str:
    """Write ``df`` as a new version of the table at ``base`` and make it
    current.  ``partition_by`` names one integral, date or text column whose
    partitions ``replace_partitions`` can replace.  ``note`` is for ``has_note``.
    Returns the version's folder."""
    spark, version = df.sparkSession, current_version(df.sparkSession, base) + 1
    path = _new_folder(base, version)
    if partition_by is None:
        write_table(df, path, mode="errorifexists", fmt=fmt)
        _commit(_entry(spark, version, path, fmt, df.schema, note), base)
    else:
        _commit(_written_partitions(df, path, version, partition_by, fmt, note), base)
    return path


def new_folder(spark: SparkSession, base: str) -> str:
    """A folder for the table's next version, for a caller that writes it
    itself and then makes it current with ``commit_folder``."""
    return _new_folder(base, current_version(spark, base) + 1)


def commit_folder(spark: SparkSession, base: str, path: str | None, schema: StructType, fmt: str = "parquet") -> None:
    """Make the files in ``path`` (None: no rows) the table's newest version."""
    _commit(_entry(spark, current_version(spark, base) + 1, path, fmt, schema), base)


def append_version(df: DataFrame, base: str, *, fmt: str = "parquet") -> str:
    """A version made of the current one's folders and one with the rows of
    ``df`` (INSERT): nothing that was stored is written again.  Columns are
    those of the table; the first append makes it."""
    spark = df.sparkSession
    log = _log_or_none(spark, base)
    if log is None:
        return write_version(df, base, fmt=fmt)
    version = current_version(spark, base) + 1
    held = _at(log).where("path IS NOT NULL")
    if held.where("partition IS NOT NULL").limit(1).count():
        raise ValueError(f"{base} is partitioned: use replace_partitions")
    df = df.select(*read_current(spark, base).columns)
    path = _new_folder(base, version)
    write_table(df, path, mode="errorifexists", fmt=fmt)
    held = held.withColumns({"version": F.lit(version).cast("long"), "note": F.lit(None).cast("string")})
    _commit(held.unionByName(_entry(spark, version, path, fmt, df.schema)), base)
    return path


def _partition_name(by: str, value) -> F.Column:
    """A partition's folder name.  Text is written escaped; compare names that Spark made."""
    return F.concat(F.lit(f"{by}="), F.coalesce(value.cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))


def _written_partitions(df: DataFrame, path: str, version: int, by: str, fmt: str,
                        note: str | None = None) -> DataFrame:
    """Write ``df`` by partition and return the log rows of its folders, with
    one row without a path if there are none."""
    spark, schema = df.sparkSession, df.schema
    if not isinstance(schema[by].dataType, (IntegralType, DateType)):
        raise ValueError(f"cannot replace partitions by {by}: {schema[by].dataType.simpleString()}")
    # one file per partition where it is small, several where it is large
    write_table(df.hint("rebalance", F.col(by)), path, mode="errorifexists", fmt=fmt, partition_by=[by])
    ordered = StructType([f for f in schema.fields if f.name != by] + [schema[by]])
    rows = spark.read.format(fmt).schema(ordered).load(path).select(by).distinct()
    rows = rows.select(_partition_name(by, F.col(by)).alias("partition"))
    rows = rows.select(F.lit(version).cast("long").alias("version"), F.concat(F.lit(f"{path}/"), "partition").alias("path"),
                       F.lit(fmt).alias("format"), "partition", F.lit(schema.json()).alias("schema"),
                       F.lit(time.time_ns()).alias("written_at"), F.lit(None).cast("string").alias("note"))
    return rows.unionByName(_entry(spark, version, None, fmt, schema, note))


def replace_partitions(df: DataFrame, base: str, by: str, keys: DataFrame | None = None, *,
                       fmt: str = "parquet", note: str | None = None) -> str:
    """A version in which the partitions named by ``keys`` (a DataFrame with
    column ``by``; default: those of ``df``) hold the rows of ``df`` and all
    others are as before.  Only the named partitions are written; one without
    rows in ``df`` disappears.  A row of ``df`` outside ``keys`` raises.
    Returns the new folder."""
    spark = df.sparkSession
    log = _log_or_none(spark, base)
    if log is None:
        return write_version(df, base, fmt=fmt, partition_by=by, note=note)
    version = current_version(spark, base) + 1
    old = _at(log).where("path IS NOT NULL")
    if old.where("partition IS NULL").limit(1).count():
        raise ValueError(f"{base} is not partitioned by {by}")
    df = df.select(*read_current(spark, base).columns)
    if keys is not None:
        keys = keys.select(F.col(by).cast(df.schema[by].dataType)).distinct()
        named = df.join(keys.withColumn("_named", F.lit(True)), df[by].eqNullSafe(keys[by]), "left")
        said = F.when(F.col("_named"), F.lit(True)).otherwise(F.raise_error(F.concat(
            F.lit(f"row of a partition that is not replaced: {by}="), F.coalesce(df[by].cast("string"), F.lit("NULL")))))
        df = named.where(said.cast("boolean")).select(*[df[c] for c in df.columns])
    path = _new_folder(base, version)
    fresh = _written_partitions(df, path, version, by, fmt, note)
    gone = fresh.where("partition IS NOT NULL").select("partition")
    if keys is not None:
        gone = gone.unionByName(keys.select(_partition_name(by, F.col(by)).alias("partition"))).distinct()
    kept = old.join(gone, "partition", "left_anti").select(*old.columns)
    kept = kept.withColumns({"version": F.lit(version).cast("long"), "note": F.lit(None).cast("string")})
    _commit(kept.unionByName(fresh), base)
    return path


def read_version(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """A version of the table at ``base``, the newest unless one is given.
    One row per folder is read from the log."""
    rows = _at(version_log(spark, base), version).collect()
    if not rows:
        raise FileNotFoundError(f"no committed version under {base}")
    paths = [r["path"] for r in rows if r["path"] is not None]
    told = next((r["schema"] for r in rows if r["schema"]), None)
    schema = StructType.fromJson(json.loads(told)) if told else None
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.format(rows[0]["format"])
    if not any(r["partition"] for r in rows):
        return (reader.schema(schema) if schema is not None else reader).load(paths)
    by = next(r["partition"] for r in rows if r["partition"]).split("=", 1)[0]
    found = StructType([f for f in schema.fields if f.name != by]
                       + [StructField(_VERSION_DIR, StringType()), schema[by]])
    df = reader.schema(found).option("basePath", f"{_root(base)}/data").load(paths)
    return df.select(*schema.names)


def read_current(spark: SparkSession, base: str) -> DataFrame:
    """The newest committed version of the table at ``base``."""
    return read_version(spark, base)


def read_current_or_none(spark: SparkSession, base: str) -> DataFrame | None:
    """The newest version, or None for a table that was never written.  Any
    other failure (an unreadable log, a missing version) raises."""
    return None if _log_or_none(spark, base) is None else read_current(spark, base)


def current_files(spark: SparkSession, base: str) -> DataFrame:
    """(file): the data files of the newest version that hold rows."""
    return read_current(spark, base).select(F.col("_metadata.file_path").alias("file")).distinct()


# --------------------------------------------------------------------------
# retention
# --------------------------------------------------------------------------

@contextmanager
def reading(spark: SparkSession, base: str, seconds: int = 6 * 3600) -> Iterator[DataFrame]:
    """The newest version, registered as in use: ``remove_superseded`` spares
    it until the block ends (or ``seconds`` have passed, should it never end)."""
    reader, version = uuid.uuid4().hex, current_version(spark, base)
    if not version:
        raise FileNotFoundError(f"no committed version under {base}")

    def note(until: int) -> None:
        (spark.createDataFrame([(reader, version, until)], READER_SCHEMA).coalesce(1)
         .write.mode("append").parquet(f"{_root(base)}/readers"))

    note(time.time_ns() + seconds * 10**9)
    try:
        yield read_version(spark, base, version)
    finally:
        note(0)


def _versions_in_use(spark: SparkSession, base: str) -> set[int]:
    try:
        notes = spark.read.schema(READER_SCHEMA).parquet(f"{_root(base)}/readers")
        ended = notes.where("until = 0").select("reader").distinct()
        live = notes.where(F.col("until") > time.time_ns()).join(ended, "reader", "left_anti")
        return {r[0] for r in live.select("version").distinct().collect()}
    except AnalysisException as e:
        if is_missing(e):
            return set()
        raise


def remove_superseded(spark: SparkSession, base: str, keep: int = 2, older_than_seconds: int = 0,
                      unlogged_after_seconds: int | None = None) -> list[str]:
    """Delete the folders that neither the newest ``keep`` versions nor a
    version in use refer to, if written ``older_than_seconds`` ago or before.
    Folders that kept versions took over stay.  With ``unlogged_after_seconds``
    also those of failed writes, which no version names, if nothing was written
    for so long; choose more than any write takes.  Returns the deleted folders."""
    if keep < 1:
        raise ValueError("the current version is always kept")
    log = _log_or_none(spark, base)
    if log is None:
        return []
    newest = {r[0] for r in log.select("version").distinct().orderBy(F.desc("version")).limit(keep).collect()}
    wanted = sorted(newest | _versions_in_use(spark, base))
    folders = log.where("path IS NOT NULL").groupBy("path").agg(
        F.max(F.col("version").isin(wanted)).alias("held"), F.min("written_at").alias("written_at"))
    limit = time.time_ns() - older_than_seconds * 10**9
    old = folders.where(~F.col("held") & (F.coalesce("written_at", F.lit(0)) <= limit)).select("path").collect()
    sc, gone = spark.sparkContext, []
    for row in old:
        where = sc._jvm.org.apache.hadoop.fs.Path(row["path"])
        if where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True):
            gone.append(row["path"])
    if unlogged_after_seconds is not None:
        gone += _remove_unlogged(spark, base, log, unlogged_after_seconds)
    return sorted(gone)


def _remove_unlogged(spark: SparkSession, base: str, log: DataFrame, seconds: int) -> list[str]:
    name = F.regexp_extract("path", rf"/({_VERSION_DIR}=[^/]+)", 1)
    logged = {r[0] for r in log.where("path IS NOT NULL").select(name).distinct().collect()}
    sc, gone = spark.sparkContext, []
    data = sc._jvm.org.apache.hadoop.fs.Path(f"{_root(base)}/data")
    fs = data.getFileSystem(sc._jsc.hadoopConfiguration())
    for found in fs.listStatus(data) if fs.exists(data) else ():
        where, age = found.getPath(), time.time() - found.getModificationTime() / 1000
        if where.getName() not in logged and age >= seconds and fs.delete(where, True):
            gone.append(where.toString())
    return gone


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch copy that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
