"""Readers for the warehouse's input tables (one Parquet dataset each)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """``spark.read.parquet(base_dir/name.parquet)`` projected to ``columns``
    so the scan's ReadSchema holds only what the caller uses."""
    df = spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
