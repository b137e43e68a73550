"""Relational operators over DataFrames."""

from starloom.operators.analyses import (
    compare_to_group_mean,
    count_by_bucket,
    entity_records,
    join_group_values,
    mean_by_bucket,
    period_leaders,
    share_of_group,
)
from starloom.operators.calendar import calendar_dimension, insert_if_absent
from starloom.operators.fact import (
    Enrichment,
    assemble_fact,
    enrich,
    replace_keys,
    rollup_children,
)
from starloom.operators.keys import (
    Lookup,
    assign_surrogate_keys,
    lookup_keys,
    max_key,
    one_row_per_key,
    quarantine,
)
from starloom.operators.ranking import rank_within
from starloom.operators.scd1 import scd1_merge

__all__ = [
    "Enrichment", "Lookup", "assemble_fact", "assign_surrogate_keys",
    "calendar_dimension", "compare_to_group_mean", "count_by_bucket",
    "enrich", "entity_records", "insert_if_absent", "join_group_values", "lookup_keys", "max_key", "one_row_per_key",
    "mean_by_bucket", "period_leaders", "quarantine", "rank_within", "replace_keys", "rollup_children",
    "scd1_merge", "share_of_group",
]
