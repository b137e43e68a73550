"""Dashboard analyses over a star schema.

None of these puts a whole group into one task: group-level figures come from
grouped aggregates (partial aggregation before the shuffle) joined back to the
rows they describe, and windows run only over already-aggregated tables whose
per-partition size is one row per member of the group.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.numeric import exact_sum
from starloom.operators.ranking import rank_within


def _cols(xs: Sequence[str]) -> list[str]:
    return list(xs)


def _decimal_sum(col: Column, in_type: str, out_type: str) -> Column:
    """Exact SUM, accumulated with 38 digits for decimal inputs."""
    m = re.fullmatch(r"decimal\((\d+),(\d+)\)", in_type.replace(" ", ""))
    if m:
        return exact_sum(col, int(m.group(2)), out_type)
    return F.sum(col).cast(out_type)


def join_group_values(units: DataFrame, groups: DataFrame, keys: Sequence[str], *,
                      how: str = "left") -> DataFrame:
    """Attach per-group values (one row per group key) to every unit row.

    The join is an equi-join that Spark plans from bytes: a small group table
    is broadcast; otherwise both sides shuffle on the (null-safe) key, which
    differs from the aggregate's own partitioning, so the group side is an
    exchange of its own and AQE's skew-join handling can split the units of a
    hot group over many tasks.  Nothing is replicated but that group's row.
    """
    keys = _cols(keys)
    # NULL is a group of its own (as in PARTITION BY): match keys null-safely
    right = groups.select(*[F.col(k).alias(f"_jg_{k}") for k in keys],
                          *[c for c in groups.columns if c not in keys])
    cond = None
    for k in keys:
        c = units[k].eqNullSafe(right[f"_jg_{k}"])
        cond = c if cond is None else cond & c
    return units.join(right, cond, how).drop(*[f"_jg_{k}" for k in keys])


def period_leaders(values: DataFrame, entity: Sequence[str], period: Sequence[str],
                   measure: str) -> DataFrame:
    """Rows of ``values`` (one per entity and period) holding the period's
    largest ``measure`` -- RANK() = 1, ties included -- computed as a grouped
    max joined back on (period, max)."""
    period = _cols(period)
    best = values.groupBy(*period).agg(F.max(measure).alias("_best"))
    j = join_group_values(values, best, period, how="inner")
    return j.where(F.col(measure) == F.col("_best")).drop("_best")


def count_by_bucket(leaders: DataFrame, entity: Sequence[str], bucket: Column,
                    bucket_name: str, count_name: str) -> DataFrame:
    """Leaderships counted per (bucket, entity), e.g. seasons led per decade."""
    return (leaders.withColumn(bucket_name, bucket)
            .groupBy(bucket_name, *_cols(entity))
            .agg(F.count(F.lit(1)).alias(count_name)))


def entity_records(events: DataFrame, entity: str, category_col: str,
                   categories: dict[str, str], *, value_col: str | None = None,
                   value_name: str | None = None, value_type: str = "decimal(12,2)",
                   total_type: str = "decimal(38,2)",
                   rank_by: Sequence[str] = (), top_k: int | None = None) -> DataFrame:
    """Per entity: one count per category (``{category value: output name}``)
    as conditional sums, optionally a value total; then, when ``top_k`` is
    set, the top-k entities ordered by ``rank_by`` descending and the entity
    key ascending as tie-break.  The top-k is a per-partition bounded heap
    merged once (``TakeOrderedAndProject``), never a global sort."""
    aggs = [F.sum(F.when(F.col(category_col) == F.lit(v), 1).otherwise(0)).cast("bigint").alias(name)
            for v, name in categories.items()]
    if value_col:
        scale = F.col(value_col).cast(value_type)
        aggs.append(_decimal_sum(scale, value_type, total_type).alias(value_name or "total_value"))
    per = events.groupBy(entity).agg(*aggs)
    if top_k is None:
        return per
    order = [F.col(c).desc() for c in rank_by] + [F.col(entity).asc()]
    return per.orderBy(*order).limit(top_k)


def compare_to_group_mean(units: DataFrame, group: Sequence[str], value: str, *,
                          mean_name: str = "group_mean", delta_name: str = "vs_group_mean",
                          exact_sum_type: str = "decimal(38,4)") -> DataFrame:
    """Each unit beside its group's mean value and its distance from it.

    The mean is ``CAST(SUM(value) AS DOUBLE) / COUNT(*)`` over an exact
    decimal sum, from a grouped aggregate joined back on the group key (a hot
    group is combined map-side; see ``join_group_values``).  ``units`` is read
    twice: store it first if it is expensive.
    """
    group = _cols(group)
    total = _decimal_sum(F.col(value), dict(units.dtypes)[value], exact_sum_type)
    means = units.groupBy(*group).agg(
        (total.cast("double") / F.count(F.lit(1))).alias(mean_name))
    return (join_group_values(units, means, group)
            .withColumn(delta_name, F.col(value).cast("double") - F.col(mean_name)))


def mean_by_bucket(units: DataFrame, bucket: str, value: str, *,
                   count_name: str = "units", mean_name: str = "mean_value",
                   exact_sum_type: str = "decimal(38,4)") -> DataFrame:
    """Mean value per bucket (e.g. mean order value by line count)."""
    total = _decimal_sum(F.col(value), dict(units.dtypes)[value], exact_sum_type)
    return units.groupBy(bucket).agg(
        F.count(F.lit(1)).alias(count_name),
        (total.cast("double") / F.count(F.lit(1))).alias(mean_name))


def share_of_group(values: DataFrame, member: Sequence[str], group: Sequence[str],
                   period: Sequence[str], measure: str, *,
                   group_total_name: str = "group_value", share_name: str = "share",
                   rank_name: str = "group_rank", total_type: str = "decimal(38,2)") -> DataFrame:
    """Each member's share of its group's total per period, beside the
    group's rank (1 = largest total) among groups in that period.

    ``values`` holds one row per (member, group, period).  Group totals are a
    grouped aggregate; the rank is ``rank_within`` over that aggregate (prefix
    sums over range partitions).  The totals are joined back on (group,
    period) with ``join_group_values``.
    """
    member, group, period = _cols(member), _cols(group), _cols(period)
    mtype = dict(values.dtypes)[measure]
    totals = values.groupBy(*group, *period).agg(
        _decimal_sum(F.col(measure), mtype, total_type).alias(group_total_name))
    ranked = rank_within(totals, period, group_total_name, rank_name)
    out = join_group_values(values, ranked, group + period)
    return out.withColumn(
        share_name, F.col(measure).cast("double") / F.col(group_total_name).cast("double"))
