"""Mixed-format date parsing and calendar keys."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted date layouts, in the order they are tried.
# Day-first is tried before month-first, so "05/04/2021" reads as 5 April.
DEFAULT_DATE_FORMATS: tuple[str, ...] = (
    "yyyy-MM-dd",
    "dd-MM-yyyy",
    "dd/MM/yyyy",
    "MM/dd/yyyy",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# What each pattern letter run can match when parsing, as a
# regular expression (a superset of what the parser accepts).  Layouts with
# other letters (month names, ...) get no pre-check.
_TOKEN_REGEX = {"yyyy": r"[+-]?\d{4,10}", "MM": r"\d{2}", "dd": r"\d{2}"}


def layout_regex(fmt: str) -> str | None:
    """A regular expression every text parseable with ``fmt`` matches, or
    None when the layout uses tokens not covered here."""
    out, i = ["^"], 0
    while i < len(fmt):
        ch = fmt[i]
        if ch.isalpha():
            j = i
            while j < len(fmt) and fmt[j] == ch:
                j += 1
            token = fmt[i:j]
            if token not in _TOKEN_REGEX:
                return None
            out.append(_TOKEN_REGEX[token])
            i = j
        else:
            out.append(re.escape(ch))
            i += 1
    out.append("$")
    return "".join(out)


def parse_date_any(text: Column | str,
                   formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> Column:
    """First layout that parses wins; text matching none gives NULL.

    Uses ``try_to_date`` so bad text never raises under ANSI mode.  Each
    layout is only attempted on text whose shape can match it (a cheap
    regular-expression test): a failed parse is far more expensive than a
    successful one, and with several layouts most attempts would fail.
    Callers project the result into a column once and reuse it for both the
    stored value and any join key.
    """
    c = _col(text)
    attempts = []
    for fmt in formats:
        rx = layout_regex(fmt)
        parsed = F.try_to_date(c, fmt)
        attempts.append(F.when(c.rlike(rx), parsed) if rx else parsed)
    return F.coalesce(*attempts)


def date_key(d: Column | str) -> Column:
    """yyyyMMdd as INT (e.g. 2021-03-28 -> 20210328), computed arithmetically
    rather than through string formatting."""
    c = _col(d)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")
