"""Lap-time text (``M:SS.mmm``) to integer milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted lap-time layout.  Minutes (1-6 digits), a colon,
# two-digit seconds 00-59, and an optional fraction of 1-3 digits that is
# right-padded to milliseconds ("1:26.5" is 86 500 ms).  The end anchor is
# \z: Java's $ would also accept a trailing line break.
LAP_TIME_PATTERN = r"^(\d{1,6}):([0-5]\d)(\.\d{1,3})?\z"


def lap_time_ms(text: Column | str, missing: str = "zero") -> Column:
    """Parse lap-time text into INT milliseconds.

    Leading/trailing spaces are ignored.  Anything that is not
    ``M:SS[.f{1,3}]`` -- NULL, empty, placeholders such as ``\\N``, bare
    numbers, hour-qualified times -- is *missing*: 0 when ``missing="zero"``
    (qualifying sessions) or NULL when ``missing="null"`` (fastest lap).
    """
    if missing not in ("zero", "null"):
        raise ValueError("missing must be 'zero' or 'null'")
    c = F.col(text) if isinstance(text, str) else text
    s = F.trim(c)
    # Once the layout is validated the fields sit at fixed places around the
    # single colon, so plain substring functions (no second regex) cut them.
    rest = F.substring_index(s, ":", -1)          # "SS" or "SS.f{1,3}"
    ms = (
        F.substring_index(s, ":", 1).cast("bigint") * 60000
        + F.substring(rest, 1, 2).cast("bigint") * 1000
        + F.rpad(F.substring(rest, 4, 3), 3, "0").cast("bigint")
    )
    # CASE evaluates the branch only for rows that matched the layout, so the
    # casts above never see malformed text.
    value = F.when(s.rlike(LAP_TIME_PATTERN), ms.try_cast("int"))
    if missing == "zero":
        return F.coalesce(value, F.lit(0))
    return value
