"""Column functions: all return ``pyspark.sql.Column`` built from built-in
Spark SQL expressions, so they stay inside whole-stage codegen."""

from starloom.functions.dates import DEFAULT_DATE_FORMATS, date_key, parse_date_any
from starloom.functions.numeric import (
    default_zero,
    exact_sum,
    least_positive,
    money_units,
    positions_gained,
    safe_cast,
    units_sum,
)
from starloom.functions.text import blank_to_null, full_name, null_tokens_to_null, trimmed
from starloom.functions.times import lap_time_ms

__all__ = [
    "DEFAULT_DATE_FORMATS",
    "blank_to_null",
    "date_key",
    "default_zero",
    "exact_sum",
    "full_name",
    "lap_time_ms",
    "least_positive",
    "money_units",
    "null_tokens_to_null",
    "parse_date_any",
    "positions_gained",
    "safe_cast",
    "units_sum",
    "trimmed",
]
