"""Numeric helpers: safe/strict casts, best-of-N, grid deltas, defaults."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Ranges of the narrow integer types.
_INT_RANGES = {
    "tinyint": (-128, 127), "byte": (-128, 127),
    "smallint": (-32768, 32767), "short": (-32768, 32767),
    "int": (-2147483648, 2147483647), "integer": (-2147483648, 2147483647),
}


def safe_cast(c: Column | str, to: str, *, text: bool = True) -> Column:
    """TRY_CAST: NULL on unparseable text *or* overflow, never an error.

    Same results as ``try_cast``, on a faster path for raw text:

    * text without a digit of any script (``\\N``, ``R``, empty) can be no
      integer or decimal, so it is answered NULL before the cast -- a failing
      TRY_CAST is far slower than a successful one;
    * narrow integer targets go through BIGINT plus a range check, because a
      direct TRY_CAST to TINYINT is slow for every out-of-range value.

    Pass ``text=False`` when the input is already numeric.
    """
    col = _col(c)
    target = to.strip().lower()
    rng = _INT_RANGES.get(target)
    exact_numeric = rng is not None or target in ("bigint", "long") or target.startswith("decimal")
    if text and exact_numeric:
        col = F.when(col.cast("string").rlike(r"\p{Nd}"), col)
    if rng is None:
        return col.try_cast(to)
    wide = col.try_cast("bigint")
    return F.when(wide.between(*rng), wide.cast(to))


def least_positive(*cols: Column | str) -> Column:
    """Smallest strictly positive value among the inputs; NULL if none.

    Zero and NULL both count as "no time" (a session not run), so the best
    of ``(0, 86572, NULL)`` is 86572.  ``least`` skips NULLs.
    """
    cs = [_col(c) for c in cols]
    return F.least(*[F.when(c > 0, c) for c in cs])


def positions_gained(grid: Column | str, finish: Column | str,
                     out_type: str = "smallint") -> Column:
    """grid - finish when both are positive, else NULL (grid 0 = pit-lane
    start, finish NULL/0 = not classified)."""
    g, f = _col(grid), _col(finish)
    return F.when((g > 0) & (f > 0), (g.cast(out_type) - f.cast(out_type)).cast(out_type))


def default_zero(c: Column | str, out_type: str | None = None) -> Column:
    """COALESCE(c, 0) -- e.g. a child count after a left join."""
    out = F.coalesce(_col(c), F.lit(0))
    return out.cast(out_type) if out_type else out


def units_sum(units: Column | str, scale: int, out_type: str | None = None) -> Column:
    """SUM of BIGINT amounts counted in units of 10^-scale, returned as an
    exact DECIMAL (``out_type``, default ``decimal(38, scale)``).

    The amounts are summed in three parts of 21 bits (the highest keeps the
    sign), each in fixed-width arithmetic that holds 4 x 10^12 rows a group,
    and put together once per group."""
    u = _col(units)
    low = F.lit((1 << 21) - 1).cast("bigint")
    parts = (u.bitwiseAND(low), F.shiftright(u, 21).bitwiseAND(low), F.shiftright(u, 42))
    wide = [F.sum(p).cast("decimal(25,0)") for p in parts]
    total = (wide[2] * F.lit(1 << 21).cast("decimal(8,0)") + wide[1]).cast("decimal(30,0)")
    total = (total * F.lit(1 << 21).cast("decimal(7,0)") + wide[0]).cast("decimal(38,0)")
    return _scaled(total, scale, out_type)


def _scaled(total: Column, scale: int, out_type: str | None) -> Column:
    """``total`` units of 10^-scale as a decimal with ``scale`` digits."""
    unit = F.lit(Decimal(1).scaleb(-scale)).cast(f"decimal({scale + 1},{scale})")
    return (total.cast(f"decimal({38 - scale},0)") * unit).cast(out_type or f"decimal(38,{scale})")


def exact_sum(c: Column | str, scale: int, out_type: str | None = None) -> Column:
    """SUM of a DECIMAL value with ``scale`` fraction digits, accumulated with
    38 digits, whatever the precision of the input; ``out_type`` defaults to
    ``decimal(38, scale)``."""
    return F.sum(_col(c).cast(f"decimal(38,{scale})")).cast(out_type or f"decimal(38,{scale})")


def money_units(c: Column | str, scale: int = 2) -> Column:
    """A DOUBLE amount with at most ``scale`` decimals (a price, a balance) as
    BIGINT units of 10^-scale, rounded to the nearest unit -- the same value
    a cast to DECIMAL(p, scale) gives for such amounts, at a fraction of the
    cost.  (It can differ from Spark's binary-exact cast only for doubles
    within ~1e-14 of a half unit, which amounts with ``scale`` decimals never
    are.)"""
    return F.round(_col(c) * F.lit(10 ** scale)).cast("bigint")
