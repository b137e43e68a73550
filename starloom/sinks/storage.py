"""Writing tables: overwrite, append with a column list, truncate, file export.
Tables that are replaced while they are read are versioned, see ``versions``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.operators.keys import all_not_null


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def write_table(df: DataFrame, target: str, *, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: Sequence[str] | None = None, options: dict | None = None) -> None:
    """Write ``df`` to a path or a catalog table (overwrite replaces data and
    schema, as a bronze load does)."""
    w = df.write.mode(mode).format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if _is_path(target):
        w.save(target)
    else:
        if mode == "overwrite" and fmt == "delta":
            w = w.option("overwriteSchema", "true")
        w.saveAsTable(target)


def replace_table(df: DataFrame, target: str, *, fmt: str = "parquet") -> None:
    """Replace a catalog table's data and schema: the new table is written
    beside the old one and takes its name once it is whole.  A failed write
    leaves the old table as it was."""
    spark, beside = df.sparkSession, f"{target}__next"
    spark.sql(f"DROP TABLE IF EXISTS {beside}")
    try:
        write_table(df, beside, mode="errorifexists", fmt=fmt)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {beside}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    spark.sql(f"ALTER TABLE {beside} RENAME TO {target}")


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """CREATE DATABASE IF NOT EXISTS (idempotent), in the warehouse unless a
    folder is given."""
    where = "" if location is None else f" LOCATION '{location}'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def create_table(spark: SparkSession, target: str, schema: StructType, *, replace: bool = False,
                 fmt: str = "parquet") -> None:
    """Create an empty table with declared columns at a path or catalog name.
    Without ``replace`` an existing table is an error (CREATE TABLE); with it,
    the table is replaced (CREATE OR REPLACE TABLE)."""
    mode = "overwrite" if replace else "errorifexists"
    write_table(spark.createDataFrame([], schema), target, mode=mode, fmt=fmt)


def project_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """INSERT with a column list: columns of ``schema`` missing from ``df``
    become typed NULLs, present ones are cast to the declared type, and the
    order follows the schema."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def require_not_null(df: DataFrame, cols: Sequence[str], what: str = "table") -> DataFrame:
    """``df``; a row with NULL in a NOT NULL column raises when it is written."""
    if not cols:
        return df
    ok = all_not_null(cols)
    names = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return df.where(F.when(ok, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit(f"NULL in a NOT NULL column of {what}: "), names)).cast("boolean")))


def append_rows(df: DataFrame, target: str, schema: StructType, fmt: str = "parquet") -> None:
    """INSERT INTO with a column list: only the new rows are written."""
    write_table(project_to_schema(df, schema), target, mode="append", fmt=fmt)


def truncate(spark: SparkSession, target: str, schema: StructType | None = None,
             fmt: str = "parquet") -> None:
    """Empty a table, keeping its schema."""
    if not _is_path(target):
        spark.sql(f"TRUNCATE TABLE {target}")
        return
    if schema is None:
        schema = spark.read.format(fmt).load(target).schema
    write_table(spark.createDataFrame([], schema), target, mode="overwrite", fmt=fmt)


def is_missing(error: AnalysisException) -> bool:
    """Whether the error says that a path or table does not exist (yet)."""
    return error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def export(df: DataFrame, path: str, *, fmt: str = "csv", header: bool = True, sep: str = ",",
           partition_by: Sequence[str] | None = None) -> None:
    """Export for BI tools: a folder with one file per task."""
    opts = {"header": str(header).lower(), "sep": sep} if fmt == "csv" else {}
    write_table(df, path, mode="overwrite", fmt=fmt, partition_by=partition_by, options=opts)
