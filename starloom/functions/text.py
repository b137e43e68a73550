"""Text cleansing helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Placeholder tokens that mean "no value" in raw delimited files.
DEFAULT_NULL_TOKENS: tuple[str, ...] = ("", "\\N")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    """TRIM: removes leading/trailing spaces."""
    return F.trim(_col(c))


def blank_to_null(c: Column | str) -> Column:
    """NULLIF(c, '')."""
    return F.nullif(_col(c), F.lit(""))


def null_tokens_to_null(c: Column | str,
                        tokens: Sequence[str] = DEFAULT_NULL_TOKENS) -> Column:
    """NULL when the text equals one of the placeholder tokens."""
    cc = _col(c)
    return F.when(~cc.isin(*tokens), cc)


def full_name(first: Column | str, last: Column | str, sep: str = " ") -> Column:
    """CONCAT(TRIM(first), sep, TRIM(last)); NULL when either part is NULL
    (``concat``, unlike ``concat_ws``, propagates NULL)."""
    return F.concat(trimmed(first), F.lit(sep), trimmed(last))
