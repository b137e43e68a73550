"""Schema drift: the columns of a delivery against those of the stored table.

A column may be new, missing, of a wider type (every stored value fits it), of
a narrower one (the delivery is cast to the stored type without loss), or of a
type that fits neither way.  ``reconcile`` brings a delivery into the stored
table's shape with the changes that are allowed, and refuses others by name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# The kinds of change.
ADDED, MISSING, WIDENED, NARROWER, INCOMPATIBLE = "added", "missing", "widened", "narrower", "incompatible"
#: Changes that are applied unless the caller says otherwise.
ALLOWED = (ADDED, WIDENED, NARROWER)

# The digits before the decimal point that an integral type needs as a decimal.
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)


class SchemaDrift(ValueError):
    """Changes that are not allowed; ``changes`` lists them."""

    def __init__(self, changes: Sequence[Change]):
        super().__init__("schema drift: " + "; ".join(str(c) for c in changes))
        self.changes = list(changes)


@dataclass(frozen=True)
class Change:
    column: str
    kind: str
    stored: str | None
    landed: str | None

    def __str__(self) -> str:
        return f"{self.column} {self.kind} ({self.stored or '-'} to {self.landed or '-'})"


def fits(narrow: DataType, wide: DataType) -> bool:
    """Whether every value of ``narrow`` is one of ``wide``."""
    if narrow == wide:
        return True
    a, b = type(narrow), type(wide)
    if a in _INTEGRAL and b in _INTEGRAL:
        return _INTEGRAL.index(a) < _INTEGRAL.index(b)
    if a in _INTEGRAL and b is DecimalType:
        return wide.precision - wide.scale >= _DIGITS[a]
    if a is DecimalType and b is DecimalType:
        return wide.scale >= narrow.scale and wide.precision - wide.scale >= narrow.precision - narrow.scale
    if b is DoubleType:
        return a is FloatType or a in _INTEGRAL[:3]  # a double holds 53 bits
    if b is FloatType:
        return a in _INTEGRAL[:2]
    return a is DateType and b in (TimestampType, TimestampNTZType)


def compare_schemas(stored: StructType, landed: StructType) -> list[Change]:
    """What differs, by name (case aside)."""
    old = {f.name.lower(): f for f in stored.fields}
    new = {f.name.lower(): f for f in landed.fields}
    out = []
    for name, f in new.items():
        told = f.dataType.simpleString()
        if name not in old:
            out.append(Change(f.name, ADDED, None, told))
        elif f.dataType != old[name].dataType:
            kept = old[name].dataType
            kind = WIDENED if fits(kept, f.dataType) else NARROWER if fits(f.dataType, kept) else INCOMPATIBLE
            out.append(Change(old[name].name, kind, kept.simpleString(), told))
    out += [Change(f.name, MISSING, f.dataType.simpleString(), None) for n, f in old.items() if n not in new]
    return out


def reconcile(landed: DataFrame, stored: StructType, allow: Sequence[str] = ALLOWED) -> tuple[DataFrame, list[Change]]:
    """``landed`` with the stored columns first, in their order and spelling,
    then new ones; widened columns have the wider type, narrower ones the
    stored type, missing ones (if allowed) are NULL.  A change of another kind
    than those in ``allow`` raises ``SchemaDrift``; an incompatible one always
    does.  Returns the rows and the changes."""
    changes = compare_schemas(stored, landed.schema)
    refused = [c for c in changes if c.kind == INCOMPATIBLE or c.kind not in allow]
    if refused:
        raise SchemaDrift(refused)
    kind = {c.column.lower(): c.kind for c in changes}
    have = {f.name.lower(): f for f in landed.schema.fields}
    cols = []
    for f in stored.fields:
        told = kind.get(f.name.lower())
        if told == MISSING:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            found = have[f.name.lower()]
            cols.append(F.col(f"`{found.name}`").cast(found.dataType if told == WIDENED else f.dataType).alias(f.name))
    known = {f.name.lower() for f in stored.fields}
    cols += [F.col(f"`{f.name}`") for n, f in have.items() if n not in known]
    return landed.select(*cols), changes


def widened_schema(stored: StructType, landed: StructType) -> StructType:
    """The stored schema with wider types and new columns taken over: what
    readers of both old and new files can use."""
    kinds = {c.column.lower(): c.kind for c in compare_schemas(stored, landed)}
    have = {f.name.lower(): f for f in landed.fields}
    out = [StructField(f.name, have[f.name.lower()].dataType if kinds.get(f.name.lower()) == WIDENED else f.dataType)
           for f in stored.fields]
    return StructType(out + [f for n, f in have.items() if kinds.get(n) == ADDED])
