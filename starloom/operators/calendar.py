"""Calendar (date) dimension and insert-if-absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import date_key

CALENDAR_COLUMNS = (
    "date_key", "full_date", "year", "quarter", "month_num", "month_name",
    "day_of_month", "day_of_week_num", "day_of_week_name", "is_weekend",
)


def calendar_dimension(df: DataFrame, date_col: str = "full_date",
                       season_col: str | None = None,
                       season_name: str = "season",
                       load_ts=None, stamp_col: str | None = None) -> DataFrame:
    """One row per distinct non-NULL date of ``df[date_col]``.

    Columns: date_key INT (yyyyMMdd), full_date DATE, year SMALLINT,
    quarter/month_num TINYINT, month_name, day_of_month TINYINT,
    day_of_week_num TINYINT (1 = Sunday ... 7 = Saturday), day_of_week_name,
    is_weekend BOOLEAN, and ``season_name`` SMALLINT: the smallest
    ``season_col`` seen for that date (the date's own year when no season
    column is given).  Rows whose date is NULL are left out (their key would
    be NULL); callers quarantine them.

    The distinct step is a grouped aggregate: partial per map task, so even a
    date holding a third of all rows costs one row per task in the shuffle.
    """
    d = F.col(date_col).cast("date")
    base = df.select(d.alias("full_date"),
                     (F.col(season_col) if season_col else F.year(d)).alias("_season"))
    days = (base.where(F.col("full_date").isNotNull())
            .groupBy("full_date").agg(F.min("_season").alias("_season")))
    fd = F.col("full_date")
    dow = F.dayofweek(fd)
    cols = [
        date_key(fd).alias("date_key"),
        fd,
        F.year(fd).cast("smallint").alias("year"),
        F.quarter(fd).cast("tinyint").alias("quarter"),
        F.month(fd).cast("tinyint").alias("month_num"),
        F.date_format(fd, "MMMM").alias("month_name"),
        F.dayofmonth(fd).cast("tinyint").alias("day_of_month"),
        dow.cast("tinyint").alias("day_of_week_num"),
        F.date_format(fd, "EEEE").alias("day_of_week_name"),
        dow.isin(1, 7).alias("is_weekend"),
        F.col("_season").cast("smallint").alias(season_name),
    ]
    if stamp_col:
        ts = load_ts if load_ts is not None else F.current_timestamp()
        cols.append((ts if not isinstance(ts, str) else F.lit(ts)).cast("timestamp_ntz").alias(stamp_col))
    return days.select(*cols)


def insert_if_absent(new_rows: DataFrame, existing: DataFrame,
                     keys: Sequence[str] = ("date_key",)) -> DataFrame:
    """Rows of ``new_rows`` whose key is not yet in ``existing``
    (``NOT EXISTS`` as a left-anti join; only the key columns of the existing
    table are read)."""
    keys = list(keys)
    return new_rows.join(existing.select(*keys), keys, "left_anti")
