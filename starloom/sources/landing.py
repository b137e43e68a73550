"""Config-driven ingestion of delimited files from a landing folder.

A control table says which files to load, with which delimiter, into which
bronze table.  The landing folder is listed as a relation (the ``binaryFile``
source pruned to path, modification time and length -- file contents are not
read), matched to the control table on the lower-cased expected name
``file_name.file_type``, and every matched source is read and written in one
pass with its row count observed during the write.

Instead of moving loaded files elsewhere, loads are recorded in a ledger
(path, modification time, size, target table); a file whose current listing matches the
ledger is skipped on the next run, and a re-delivered file (new mtime or
size) is loaded again.

Lines that do not parse fail their source, or, with a reject table, go there:
one pass over the source writes good and bad lines side by side, and a source
fails only if more of them are bad than a limit allows.

A landing entry may be a single file (``circuits.csv``) or a folder of part
files written by another Spark job (``circuits.csv/part-*.csv``); the entry
name is the first path element below the landing folder.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from starloom.session import scratch_dir
from starloom.sinks.drift import ADDED, reconcile
from starloom.sinks.storage import ensure_database, is_missing, replace_table, write_table
from starloom.sinks.versions import commit_folder, drop_folder, new_folder, read_current_or_none, write_version

CONTROL_SCHEMA = StructType([
    StructField("file_name", StringType()),
    StructField("file_type", StringType()),
    StructField("target_table", StringType()),
    StructField("file_delimiter", StringType()),
])

LISTING_SCHEMA = StructType([
    StructField("entry", StringType()),
    StructField("expected", StringType()),
    StructField("modified", TimestampType()),
    StructField("bytes", LongType()),
    StructField("files", LongType()),
])

LEDGER_SCHEMA = StructType([
    StructField("expected", StringType()),
    StructField("entry", StringType()),
    StructField("modified", TimestampType()),
    StructField("bytes", LongType()),
    StructField("target_table", StringType()),
    StructField("rows_loaded", LongType()),
])

AUDIT_SCHEMA = StructType([
    StructField("file_name", StringType()),
    StructField("target_table", StringType()),
    StructField("status", StringType()),
    StructField("detail", StringType()),
    StructField("rows_loaded", LongType()),
    StructField("columns", IntegerType()),
])

REJECT_SCHEMA = StructType([
    StructField("target_table", StringType()),
    StructField("file_path", StringType()),
    StructField("line", StringType()),
    StructField("load", StringType()),
])

# Columns of a reject-tolerant read, besides those of the source.
_LINE, _FILE, _BAD = "_rejected_line", "_source_file", "_rejected"

# Audit statuses and skip reasons.
LOADED, SKIPPED, FAILED = "loaded", "skipped", "failed"
NO_FILE, ALREADY_LOADED = "no file", "already loaded"


def _absolute(path: str) -> str:
    """Relative local paths resolved against this process's working folder
    (the JVM would resolve them against its own)."""
    if "://" in path or path.startswith("file:"):
        return path
    return os.path.abspath(path)


def list_landing(spark: SparkSession, landing_dir: str) -> DataFrame:
    """One row per landing entry: name as listed, lower-cased name, newest
    modification time, total bytes, number of files.  A folder that does not
    exist counts as empty."""
    landing_dir = _absolute(landing_dir)
    if "://" in landing_dir:
        root = urlparse(landing_dir).path.rstrip("/")
    else:
        root = landing_dir.replace("file:", "", 1).rstrip("/")
    try:
        files = (spark.read.format("binaryFile")
                 .option("recursiveFileLookup", "true")
                 .load(landing_dir)
                 .select("path", "modificationTime", "length"))
        files.schema  # noqa: B018 -- resolves the listing now
    except AnalysisException as e:
        if not is_missing(e):
            raise
        return spark.createDataFrame([], LISTING_SCHEMA)
    entry = F.regexp_extract("path", re.escape(root) + r"/([^/]+)", 1)
    return (files.withColumn("entry", entry).where(F.col("entry") != "")
            .groupBy("entry")
            .agg(F.max("modificationTime").alias("modified"),
                 F.sum("length").alias("bytes"),
                 F.count(F.lit(1)).alias("files"))
            .select("entry", F.lower("entry").alias("expected"), "modified", "bytes", "files"))


def read_control(control: DataFrame) -> DataFrame:
    """Lower-case names and types; the expected landing name is
    ``file_name.file_type``."""
    return control.select(
        F.lower("file_name").alias("file_name"),
        F.lower("target_table").alias("target_table"),
        F.lower("file_type").alias("file_type"),
        F.col("file_delimiter"),
    ).withColumn("expected", F.concat_ws(".", "file_name", "file_type"))


@dataclass
class IngestResult:
    audit: DataFrame
    loaded: list[str]
    skipped: list[str]
    failed: list[str]


def _read_ledger(spark: SparkSession, ledger: str | None) -> DataFrame:
    if not ledger:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    ledger = _absolute(ledger)
    # first use creates an empty ledger; an existing one is left as it is
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("ignore").parquet(ledger)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)


@dataclass(frozen=True)
class Rejects:
    """Where bad lines go (``path``: a folder, one Parquet table for all
    sources) and how many a source may have: ``max_rows``, and ``max_share`` of
    its lines."""
    path: str
    max_rows: int | None = None
    max_share: float = 1.0

    def allows(self, bad: int, lines: int) -> bool:
        return (self.max_rows is None or bad <= self.max_rows) and bad <= self.max_share * lines


def read_rejects(spark: SparkSession, rejects: Rejects) -> DataFrame:
    """(target_table, file_path, line, load): the bad lines of all loads."""
    try:
        return spark.read.schema(REJECT_SCHEMA).parquet(_absolute(rejects.path)).select(*REJECT_SCHEMA.names)
    except AnalysisException as e:
        if not is_missing(e):
            raise
        return spark.createDataFrame([], REJECT_SCHEMA)


def _declared(spark: SparkSession, path: str, sep: str, schema: StructType, tolerant: bool = False) -> DataFrame:
    """The declared columns of a delimited file with a header, found by name
    (case aside) wherever they stand; a missing one is an error, others are
    not read.  Every part file must have the same header.  ``tolerant`` adds
    the text and file of lines that do not parse."""
    reader = spark.read.option("header", "true").option("sep", sep)
    names = reader.option("inferSchema", "false").csv(path).columns
    declared = {f.name.lower(): f for f in schema.fields}
    absent = sorted(set(declared) - {n.lower() for n in names})
    if absent:
        raise ValueError(f"columns not in the header: {', '.join(absent)}")
    as_landed = StructType([StructField(n, declared[n.lower()].dataType if n.lower() in declared else StringType())
                            for n in names])
    reader = reader.option("enforceSchema", "false")
    df = _tolerant(reader, as_landed, path) if tolerant else reader.option("mode", "FAILFAST").schema(as_landed).csv(path)
    return df.select(*[F.col(f"`{f.name}`").alias(f.name) for f in schema.fields],
                     *([_LINE, _FILE] if tolerant else []))


def _tolerant(reader, schema: StructType, path: str) -> DataFrame:
    """Rows of all lines; one that does not parse has its text in ``_LINE``."""
    with_line = StructType([*schema.fields, StructField(_LINE, StringType())])
    # a parser that skips the columns not asked for doesn't see that a line has too few or too many
    df = (reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE)
          .option("columnPruning", "false").schema(with_line).csv(path))
    return df.withColumn(_FILE, F.col("_metadata.file_path"))


def _load_one(spark: SparkSession, r, base: str, bronze: str, to_path: bool,
              schemas: dict[str, StructType], fmt: str, header: bool, rejects: Rejects | None,
              allow_drift: Sequence[str] | None):
    """Read one landed source and replace its bronze table in one pass,
    counting rows during the write.  The old table stays until the new one is
    written whole.  Returns (audit row, ledger row|None)."""
    expected, target = r["expected"], r["target_table"]
    if r["entry"] is None:
        return (expected, target, SKIPPED, NO_FILE, None, None), None
    if r["_entries"] > 1:
        return (expected, target, FAILED, f"{r['_entries']} landed entries differ only in case", None, None), None
    if r["_done"]:
        return (expected, target, SKIPPED, ALREADY_LOADED, None, None), None
    try:
        path, sep = f"{base}/{r['entry']}", r["file_delimiter"] or ","
        tolerant = rejects is not None
        stored = read_bronze(spark, bronze, target) if allow_drift is not None else None
        if target in schemas and header:
            df = _declared(spark, path, sep, schemas[target], tolerant)
        else:
            reader = spark.read.option("header", str(header).lower()).option("sep", sep)
            if target in schemas:
                found = schemas[target]
            else:
                found = reader.option("inferSchema", "true").csv(path).schema
            df = (_tolerant(reader, found, path) if tolerant
                  else reader.option("mode", "FAILFAST").schema(found).csv(path))
        changes: list = []
        if stored is not None:
            kept = StructType([f for f in df.schema.fields if f.name not in (_LINE, _FILE)])
            # the checks look at schemas only; the bad lines' columns go along
            shaped, changes = reconcile(df.select(*[F.col(f"`{n}`") for n in kept.names]), stored.schema, allow_drift)
            df = shaped if not tolerant else reconcile(df, stored.schema, (*allow_drift, ADDED))[0]
        if tolerant:
            n, bad, columns = _load_tolerant(spark, df, target, bronze, to_path, fmt, rejects)
            details = [f"{bad} lines rejected"] if bad else []
        else:
            n, details, columns = _load_strict(spark, df, target, bronze, to_path, fmt), [], len(df.columns)
        detail = "; ".join(details + [str(c) for c in changes]) or None
        return ((expected, target, LOADED, detail, n, columns),
                (expected, r["entry"], r["modified"], r["bytes"], target, n))
    except Exception as e:  # noqa: BLE001 -- isolate one source's failure
        return (expected, target, FAILED, f"{type(e).__name__}: {e}", None, None), None


def _load_strict(spark: SparkSession, df: DataFrame, target: str, bronze: str, to_path: bool, fmt: str) -> int:
    """Replace the bronze table by ``df``, whose first bad line raises."""
    obs = Observation(f"ingest_{target}_{uuid.uuid4().hex[:8]}")
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if to_path:
        write_version(counted, f"{bronze.rstrip('/')}/{target}", fmt=fmt)
    else:
        replace_table(counted, f"{bronze}.{target}", fmt=fmt)
    return int(obs.get["rows"])


def _load_tolerant(spark: SparkSession, df: DataFrame, target: str, bronze: str, to_path: bool, fmt: str,
                   rejects: Rejects) -> tuple[int, int, int]:
    """Good lines replace the bronze table, bad ones go to the reject table:
    one pass over the source writes both, as two partitions of one folder.
    For a bronze folder the good partition is the table's new version.  Raises,
    with bronze as it was, if the limit does not allow that many; the bad lines
    are kept then too.  Returns (rows, bad lines, columns)."""
    obs = Observation(f"ingest_{target}_{uuid.uuid4().hex[:8]}")
    bad = F.col(_LINE).isNotNull()
    names = [c for c in df.columns if c not in (_LINE, _FILE)]
    # a good line needs no file name, a bad one no parsed columns
    both = df.select(*[F.when(~bad, F.col(f"`{c}`")).alias(c) for c in names], _LINE,
                     F.when(bad, F.col(_FILE)).alias(_FILE), bad.cast("int").alias(_BAD))
    both = both.observe(obs, F.count(F.lit(1)).alias("lines"), F.coalesce(F.sum(_BAD), F.lit(0)).alias("bad"))
    base = f"{bronze.rstrip('/')}/{target}"
    folder = new_folder(spark, base) if to_path else f"{scratch_dir(spark, 'landed')}/{target}"
    write_table(both, folder, fmt=fmt if to_path else "parquet", partition_by=[_BAD])
    lines, n_bad = int(obs.get["lines"]), int(obs.get["bad"])
    good_schema = StructType([f for f in both.schema.fields if f.name in names])
    reader = spark.read.format(fmt if to_path else "parquet")
    if n_bad:
        (reader.schema(both.schema).load(f"{folder}/{_BAD}=1")
         .select(F.col(_FILE).alias("file_path"), F.col(_LINE).alias("line"), F.lit(uuid.uuid4().hex).alias("load"))
         # sources load side by side, so each has a folder of its own
         .write.mode("append").parquet(f"{_absolute(rejects.path).rstrip('/')}/target_table={target}"))
        drop_folder(spark, f"{folder}/{_BAD}=1")
    if not rejects.allows(n_bad, lines):
        drop_folder(spark, folder)
        raise ValueError(f"{n_bad} of {lines} lines rejected, more than the limit allows")
    good = f"{folder}/{_BAD}=0" if lines > n_bad else None
    if to_path:
        commit_folder(spark, base, good, good_schema, fmt)
    else:
        rows = reader.schema(good_schema).load(good) if good else spark.createDataFrame([], good_schema)
        replace_table(rows, f"{bronze}.{target}", fmt=fmt)
        drop_folder(spark, folder)
    return lines - n_bad, n_bad, len(names)


def read_bronze(spark: SparkSession, bronze: str, target: str) -> DataFrame | None:
    """The bronze table as last loaded, or None if it never was."""
    if "/" in bronze or ":" in bronze:
        return read_current_or_none(spark, f"{_absolute(bronze).rstrip('/')}/{target}")
    name = f"{bronze}.{target}"
    return spark.table(name) if spark.catalog.tableExists(name) else None


def ingest(spark: SparkSession, control: DataFrame, landing_dir: str, bronze: str, *,
           ledger: str | None = None, schemas: dict[str, StructType] | None = None,
           fmt: str = "parquet", header: bool = True, parallel: int = 4,
           rejects: Rejects | None = None, allow_drift: Sequence[str] | None = None) -> IngestResult:
    """Load every control entry whose file is in the landing folder.

    ``bronze`` is a folder (each target becomes a versioned table under
    ``bronze/<target_table>``, see ``read_bronze``) or a catalog database name
    (``<db>.<target_table>``).  ``schemas`` gives declared schemas per target
    table, whose columns are found by header name; a target without one is
    read with schema inference (an extra pass over the file).  A failing
    source does not stop the others, leaves its table as it was and is
    reported as ``failed``; a bad line fails its source, unless ``rejects`` says
    where bad lines go and how many are allowed.  ``allow_drift`` lists the kinds
    of schema change (see ``starloom.sinks.drift``) that a source may bring to a
    bronze table that is there; any other fails the source by name.  Without it
    the new schema replaces the old one.  Up to ``parallel`` sources are loaded at once
    (concurrent Spark jobs from driver threads), so many small sources do not
    leave the cluster idle.
    """
    to_path = "/" in bronze or ":" in bronze
    if to_path:
        bronze = _absolute(bronze)
    else:
        ensure_database(spark, bronze)
    ctrl = read_control(control)
    listing = list_landing(spark, landing_dir)
    done = _read_ledger(spark, ledger)
    known = ["expected", "modified", "bytes", "target_table"]
    plan = (ctrl.join(listing, "expected", "left")
            .join(done.select(*known).distinct().withColumn("_done", F.lit(True)), known, "left"))
    # names that differ only in case: one row for all of them
    plan = plan.groupBy("expected", "target_table", "file_delimiter").agg(
        F.max_by("entry", "modified").alias("entry"), F.max("modified").alias("modified"),
        F.max_by("bytes", "modified").alias("bytes"), F.max_by("_done", "modified").alias("_done"),
        F.countDistinct("entry").alias("_entries"))
    # one row per control entry: the control table is small by nature.
    rows = plan.orderBy("target_table", "expected").collect()
    base = _absolute(landing_dir).rstrip("/")
    schemas = schemas or {}
    targets = [r["target_table"] for r in rows]
    if len(set(targets)) < len(targets):
        # two sources for one table: load one after the other, in file-name
        # order (the later overwrites), never two writers on one path at once
        parallel = 1
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        results = list(pool.map(
            lambda r: _load_one(spark, r, base, bronze, to_path, schemas, fmt, header, rejects,
                                allow_drift), rows))
    audit = [a for a, _ in results]
    ledger_rows = [lr for _, lr in results if lr is not None]
    if ledger and ledger_rows:
        ledger = _absolute(ledger)
        spark.createDataFrame(ledger_rows, LEDGER_SCHEMA).coalesce(1) \
            .write.mode("append").parquet(ledger)
    by_status = {s: [a[0] for a in audit if a[2] == s] for s in (LOADED, SKIPPED, FAILED)}
    return IngestResult(spark.createDataFrame(audit, AUDIT_SCHEMA), by_status[LOADED],
                        by_status[SKIPPED], by_status[FAILED])
