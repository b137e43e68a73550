"""Type-1 slowly changing dimension upsert (MERGE semantics) on DataFrames.

Semantics kept from a SQL ``MERGE ... WHEN MATCHED THEN UPDATE ... WHEN NOT
MATCHED BY TARGET THEN INSERT``:

* source rows with a NULL natural key are ignored;
* a natural key occurring twice in the source raises when the result is read;
* matched rows take every update column from the source -- a source NULL
  overwrites -- and keep their surrogate key; the touch column gets the load
  timestamp (``only_changed=True`` restricts updates and touches to rows whose
  compared attributes differ, null-safely);
* target rows without a source row survive untouched;
* source-only rows are inserted with fresh surrogate keys
  (``max(existing) + ROW_NUMBER() OVER (ORDER BY natural key)``), the insert
  stamp set to the load timestamp and all non-inserted columns NULL.

Plan shape: the source is grouped by its natural key (which checks it and
partitions it for the join); the matched/kept part is ``target LEFT JOIN
source``, the insert part ``source LEFT ANTI target-keys``.  Only new rows go
through surrogate-key assignment, whose checkpoint is the only job that
building the result starts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.keys import (
    all_not_null,
    assign_surrogate_keys,
    max_key,
    one_row_per_key,
)

ACTION_KEPT = "kept"
ACTION_UPDATED = "updated"
ACTION_UNCHANGED = "unchanged"
ACTION_INSERTED = "inserted"


def _ts(value, dtype) -> Column:
    if isinstance(value, Column):
        return value.cast(dtype)
    if value is None:
        return F.lit(None).cast(dtype)
    return F.lit(str(value)).cast(dtype)


def scd1_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
               surrogate_key: str | None = None,
               update_cols: Sequence[str] | None = None,
               insert_cols: Sequence[str] | None = None,
               touch_col: str | None = "dw_updated_at",
               insert_stamp_col: str | None = "dw_inserted_at",
               load_ts=None,
               only_changed: bool = False,
               compare_cols: Sequence[str] | None = None,
               action_col: str | None = None,
               check_unique: bool = True) -> DataFrame:
    """Return the dimension after upserting ``source`` into ``target``.

    ``target`` has the dimension's full schema; ``source`` carries the natural
    key(s) and attribute columns named as in the target.  The output has the
    target's columns in the target's order (plus ``action_col`` if given).
    """
    keys = list(keys)
    tcols = target.columns
    ttypes = dict((f.name, f.dataType) for f in target.schema.fields)
    reserved = set(keys) | {c for c in (surrogate_key, touch_col, insert_stamp_col) if c}
    if update_cols is None:
        update_cols = [c for c in source.columns if c in ttypes and c not in reserved]
    update_cols = list(update_cols)
    if insert_cols is None:
        insert_cols = keys + update_cols
    insert_cols = list(insert_cols)
    compare_cols = list(compare_cols) if compare_cols is not None else update_cols
    for c in set(update_cols) | set(insert_cols):
        if c not in source.columns:
            raise ValueError(f"source lacks column {c!r}")

    # L10: rows without a natural key never reach the merge.
    src = source.where(all_not_null(keys)).select(
        *[F.col(c).cast(ttypes[c]).alias(c) for c in dict.fromkeys(keys + update_cols + insert_cols)])
    if check_unique:
        src = one_row_per_key(src, keys, "merge source")

    ts_type = ttypes.get(touch_col) or ttypes.get(insert_stamp_col) or "timestamp"
    stamp = _ts(load_ts if load_ts is not None else F.current_timestamp(), ts_type)

    # ---- matched + target-only rows: target LEFT JOIN source ------------------
    s_pref = {c: f"_src_{c}" for c in src.columns}
    s = src.select(*[F.col(c).alias(a) for c, a in s_pref.items()],
                   F.lit(True).alias("_src_present"))
    cond = None
    for k in keys:
        c = target[k] == s[s_pref[k]]
        cond = c if cond is None else cond & c
    j = target.join(s, cond, "left")
    present = F.col("_src_present").isNotNull()
    if only_changed:
        changed = F.lit(False)
        for c in compare_cols:
            changed = changed | ~F.col(c).eqNullSafe(F.col(s_pref[c]))
        apply = present & changed
    else:
        apply = present
    out_cols = []
    for c in tcols:
        if c in update_cols:
            out_cols.append(F.when(apply, F.col(s_pref[c])).otherwise(F.col(c)).alias(c))
        elif c == touch_col:
            out_cols.append(F.when(apply, stamp).otherwise(F.col(c)).alias(c))
        else:
            out_cols.append(F.col(c))
    if action_col:
        out_cols.append(
            F.when(~present, F.lit(ACTION_KEPT))
            .when(apply, F.lit(ACTION_UPDATED))
            .otherwise(F.lit(ACTION_UNCHANGED)).alias(action_col))
    kept_or_updated = j.select(*out_cols)

    # ---- inserts: source LEFT ANTI target ------------------------------------
    new = src.join(target.select(*keys), keys, "left_anti")
    if surrogate_key:
        new = assign_surrogate_keys(new, keys, surrogate_key, start=max_key(target, surrogate_key))
    ins_cols = []
    for c in tcols:
        if c == surrogate_key:
            ins_cols.append(F.col(c).cast(ttypes[c]))
        elif c in insert_cols:
            ins_cols.append(F.col(c))
        elif c == insert_stamp_col:
            ins_cols.append(stamp.alias(c))
        else:
            ins_cols.append(F.lit(None).cast(ttypes[c]).alias(c))
    if action_col:
        ins_cols.append(F.lit(ACTION_INSERTED).alias(action_col))
    inserted = new.select(*ins_cols)
    return kept_or_updated.unionByName(inserted)
