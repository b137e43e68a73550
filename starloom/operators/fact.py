"""Child roll-ups, star-fact assembly, targeted reload."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.keys import Lookup, lookup_keys, one_row_per_key


def rollup_children(child: DataFrame, keys: Sequence[str], value_col: str | Column, *,
                    count_name: str = "child_count",
                    sum_name: str | None = "child_total",
                    avg_name: str | None = "child_avg",
                    sum_type: str | None = None,
                    avg_input_type: str = "decimal(10,0)",
                    avg_type: str | None = "decimal(8,1)",
                    extra: Sequence[Column] = ()) -> DataFrame:
    """Per parent key: COUNT(*), SUM(value), AVG(CAST(value AS decimal)).

    The average is taken over the value cast to ``avg_input_type`` (a bare
    DECIMAL is decimal(10,0)) and stored as ``avg_type``.  Aggregation is
    partial before the shuffle, so hot parent keys are combined map-side.
    ``extra`` adds further aggregate columns to the same pass.
    """
    v = F.col(value_col) if isinstance(value_col, str) else value_col
    aggs = [F.count(F.lit(1)).alias(count_name)]
    if sum_name:
        s = F.sum(v)
        aggs.append((s.cast(sum_type) if sum_type else s).alias(sum_name))
    if avg_name:
        a = F.avg(v.cast(avg_input_type))
        aggs.append((a.cast(avg_type) if avg_type else a).alias(avg_name))
    return child.groupBy(*keys).agg(*aggs, *extra)


@dataclass
class Enrichment:
    """A left join of measures keyed like the fact (roll-ups, standings...).

    ``on`` maps fact columns to enrichment columns; ``take`` maps enrichment
    columns to output names; ``defaults`` fills values for fact rows without a
    match (e.g. a child count of 0).  With ``unique=False`` a key that the
    enrichment holds twice raises (it would fan out the fact); pass
    ``unique=True`` when that cannot be (a grouped roll-up).
    """
    df: DataFrame
    on: dict[str, str]
    take: dict[str, str]
    defaults: dict[str, object] = field(default_factory=dict)
    unique: bool = False


def enrich(fact: DataFrame, enrichments: Sequence[Enrichment]) -> DataFrame:
    out = fact
    for i, en in enumerate(enrichments):
        tag = f"_en{i}_"
        right = en.df.select(
            *[F.col(d).alias(f"{tag}{d}") for d in en.on.values()],
            *[F.col(src).alias(f"{tag}take_{dst}") for src, dst in en.take.items()])
        if not en.unique:
            right = one_row_per_key(right, [f"{tag}{d}" for d in en.on.values()], f"enrichment {i}")
        cond = None
        for fcol, dcol in en.on.items():
            c = out[fcol] == right[f"{tag}{dcol}"]
            cond = c if cond is None else cond & c
        out = out.join(right, cond, "left").drop(*[f"{tag}{d}" for d in en.on.values()])
        for dst in en.take.values():
            col = F.col(f"{tag}take_{dst}")
            if dst in en.defaults:
                col = F.coalesce(col, F.lit(en.defaults[dst]))
            out = out.withColumn(dst, col).drop(f"{tag}take_{dst}")
    return out


def assemble_fact(base: DataFrame, *, lookups: Sequence[Lookup] = (),
                  enrichments: Sequence[Enrichment] = (),
                  select: Sequence[str | Column] | None = None,
                  require: Sequence[str] | None = None) -> DataFrame:
    """Wide fact: base rows, left-joined to enrichments and dimension lookups.

    Enrichments that share the base's grain key go first so their exchanges
    line up on that key; dimension lookups follow.  ``require`` keeps only rows where those measures are non-NULL
    (the qualifying-time filter of a race fact); leave it ``None`` to keep
    every base row.
    """
    out = enrich(base, enrichments)
    out = lookup_keys(out, lookups)
    if select is not None:
        out = out.select(*select)
    if require:
        cond = None
        for c in require:
            cc = F.col(c).isNotNull()
            cond = cc if cond is None else cond & cc
        out = out.where(cond)
    return out


def replace_keys(old: DataFrame, new: DataFrame, key_cols: Sequence[str],
                 keys: DataFrame | None = None) -> DataFrame:
    """Targeted reload: rows of ``old`` whose key is in ``keys`` are replaced
    by the rows of ``new`` with those keys; all other rows of ``old`` stay.

    ``keys`` (a DataFrame with ``key_cols``) defaults to the distinct keys of
    ``new``; a key without new rows loses its old ones.
    """
    key_cols = list(key_cols)
    k = (keys if keys is not None else new).select(*key_cols).distinct()
    kept = old.join(k, key_cols, "left_anti").select(*old.columns)
    fresh = new.join(k, key_cols, "left_semi").select(*old.columns)
    return kept.unionByName(fresh)
