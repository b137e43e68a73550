"""Surrogate keys, key lookups, uniqueness checks and quarantine.

Scale notes
-----------
* ``assign_surrogate_keys`` never sorts all rows in one task.  Rows are
  range-partitioned on the natural key, the partition layout is frozen with a
  reliable ``checkpoint()`` (so a lost executor recomputes the *same*
  partition boundaries), per-partition counts (one row per partition) are
  prefix-summed, and each row gets ``start + offset(partition) +
  row_number within its partition``.  For unique keys this equals the global
  ``ROW_NUMBER() OVER (ORDER BY key)``, so ids are deterministic.  The number
  of range partitions is left to AQE, which merges small ones.
* No join here is forced: Spark and AQE choose broadcast or shuffle from the
  bytes they know or have measured.
* Uniqueness is checked inside the plan that uses it (``one_row_per_key``, the
  key window), never by a job of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import checkpoint_dir


def _duplicate(keys: Sequence[str], what: str) -> Column:
    """Raises when evaluated, naming the key that occurs twice."""
    shown = F.to_json(F.struct(*[F.col(k) for k in keys]))
    return F.raise_error(F.concat(F.lit(f"duplicate key in {what}: "), shown))


def one_row_per_key(df: DataFrame, keys: Sequence[str], what: str = "input") -> DataFrame:
    """The rows of ``df`` with a complete key, grouped by it; a key that occurs
    twice raises when the plan runs.  The aggregation is partial before the
    shuffle and leaves the rows partitioned for a join on the same key."""
    keys = list(keys)
    complete = df.where(all_not_null(keys))
    one = complete.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_slk_n"), *[F.any_value(c).alias(c) for c in df.columns if c not in keys])
    return (one.where(F.when(F.col("_slk_n") == 1, F.lit(True))
                      .otherwise(_duplicate(keys, what).cast("boolean")))
            .select(*df.columns))


def all_not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def max_key(df: DataFrame, key: str) -> Column:
    """Largest existing surrogate key, 0 for an empty table, as a scalar
    subquery: it is read when the plan that uses it runs."""
    return F.coalesce(df.agg(F.max(key).cast("bigint")).scalar(), F.lit(0).cast("bigint"))


def assign_surrogate_keys(df: DataFrame, keys: Sequence[str], key_name: str,
                          start: int | Column = 0) -> DataFrame:
    """Add ``key_name`` = ``start + ROW_NUMBER() OVER (ORDER BY keys)``.

    ``df`` must hold each natural key once (new keys only); one that occurs
    twice raises when the result is read.  The result is deterministic and
    stable across recomputation.
    """
    keys = list(keys)
    order = [F.col(k).asc_nulls_last() for k in keys]
    checkpoint_dir(df.sparkSession)
    ranged = (df.repartitionByRange(*order)
              .withColumn("_slk_part", F.spark_partition_id())
              .checkpoint(eager=True))
    counts = ranged.groupBy("_slk_part").agg(F.count(F.lit(1)).alias("_slk_n"))
    # one row per range partition
    offsets = counts.select(
        "_slk_part",
        F.coalesce(F.sum("_slk_n").over(
            Window.orderBy("_slk_part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("_slk_off"))
    within = Window.partitionBy("_slk_part").orderBy(*order)
    natural = F.struct(*[F.col(k) for k in keys])
    repeated = F.row_number().over(within) > 1
    repeated = repeated & natural.eqNullSafe(F.lag(natural).over(within))
    base = start if isinstance(start, Column) else F.lit(start)
    number = (base + F.col("_slk_off") + F.row_number().over(within)).cast("bigint")
    return (ranged.join(offsets, "_slk_part")
            .withColumn(key_name, F.when(repeated, _duplicate(keys, "rows to be keyed").cast("bigint"))
                        .otherwise(number))
            .drop("_slk_part", "_slk_off"))


@dataclass
class Lookup:
    """Natural key -> surrogate key lookup (a left join, NULL if absent).

    ``on`` maps a column of the fact (or one produced by an earlier lookup,
    for transitive lookups) to a column of ``dim``.  ``take`` lists dimension
    columns to carry over (``{dim_col: out_name}``).  Columns named in ``on``
    on the dimension side are dropped after the join.  ``unique=True`` says
    that the dimension holds each key once by construction (it was keyed or
    grouped by it); otherwise a repeated key raises instead of multiplying
    fact rows.
    """
    dim: DataFrame
    on: dict[str, str]
    take: dict[str, str] = field(default_factory=dict)
    replace: bool = True  # take-columns replace same-named fact columns
    unique: bool = False


def lookup_keys(fact: DataFrame, lookups: Sequence[Lookup], broadcast: bool = False) -> DataFrame:
    """Apply lookups in order (left joins; every fact row is kept once).

    Dimensions are pruned to the join + take columns before the join.
    ``broadcast`` is for dimensions whose rows the caller has bounded.
    """
    out = fact
    for i, lk in enumerate(lookups):
        tag = f"_lk{i}_"
        dim_cols = {d: f"{tag}{d}" for d in lk.on.values()}
        right = lk.dim.select(
            *[F.col(d).alias(a) for d, a in dim_cols.items()],
            *[F.col(src).alias(f"{tag}take_{dst}") for src, dst in lk.take.items()],
        )
        if not lk.unique:
            right = one_row_per_key(right, list(dim_cols.values()), f"lookup {sorted(lk.on.values())}")
        cond = None
        for fcol, dcol in lk.on.items():
            c = out[fcol] == right[dim_cols[dcol]]
            cond = c if cond is None else cond & c
        joined = out.join(F.broadcast(right) if broadcast else right, cond, "left")
        for dst in lk.take.values():
            if dst in out.columns:
                if not lk.replace:
                    raise ValueError(f"lookup would duplicate column {dst!r}")
                joined = joined.drop(out[dst])
        joined = joined.drop(*dim_cols.values())
        for dst in lk.take.values():
            joined = joined.withColumnRenamed(f"{tag}take_{dst}", dst)
        out = joined
    return out


def quarantine(fact: DataFrame, required: Sequence[str],
               reason_col: str = "unresolved") -> tuple[DataFrame, DataFrame]:
    """Split rows whose required key columns resolved from those that did not.

    Returns ``(resolved, quarantined)``; the quarantined rows carry
    ``reason_col`` = comma-separated names of the NULL key columns.
    """
    bad_any = None
    for c in required:
        cond = F.col(c).isNull()
        bad_any = cond if bad_any is None else bad_any | cond
    resolved = fact.where(~bad_any)
    reasons = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    bad = fact.where(bad_any).withColumn(reason_col, reasons)
    return resolved, bad
