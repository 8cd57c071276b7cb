"""Schema drift: the narrowest type that holds two, and appends that evolve a table or refuse."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeep.functions import name
from innkeep.sources.snapshots import Snapshots, Version

SAME, ADDED, MISSING, WIDENED, NARROWER, CONFLICT = "same", "added", "missing", "widened", "narrower", "conflict"

_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def widest(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds every value of both without loss; None if there is none.

    Whole numbers widen among each other and to decimals; up to 32 bits they, and
    floats, widen to doubles (a double does not hold every long). Days widen to
    timestamps. Structs widen field by field, arrays by element. Text is no wider
    than numbers: what is a number here and text there is a conflict.
    """
    if a == b:
        return a
    kinds = {type(a), type(b)}
    if kinds <= set(_WHOLE):
        return max((a, b), key=lambda t: _WHOLE.index(type(t)))
    if T.DecimalType in kinds and kinds <= {T.DecimalType, *_WHOLE}:
        parts = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0) for t in (a, b)]
        before, after = max(p for p, _ in parts), max(s for _, s in parts)
        return T.DecimalType(before + after, after) if before + after <= 38 else None
    if T.DoubleType in kinds and kinds <= {T.DoubleType, T.FloatType, *_WHOLE[:3]}:
        return T.DoubleType()
    if T.FloatType in kinds and kinds <= {T.FloatType, *_WHOLE[:2]}:
        return T.FloatType()
    if T.FloatType in kinds and T.IntegerType in kinds:
        return T.DoubleType()
    if kinds in ({T.DateType, T.TimestampType}, {T.DateType, T.TimestampNTZType}):
        return a if not isinstance(a, T.DateType) else b
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        inner = widest(a.elementType, b.elementType)
        return inner and T.ArrayType(inner, a.containsNull or b.containsNull)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        merged, changes = merged_schema(a, b)
        return None if any(c.change == CONFLICT for c in changes) else merged
    return None


def narrowest(df: DataFrame, column: str, least: T.DataType = T.ByteType()) -> str:
    """The narrowest whole type, from ``least`` up, that holds every value of the column, as
    a reader that infers types would find it. One narrow aggregate."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    kinds = [k() for k in _WHOLE[_WHOLE.index(type(least)):]]
    bits = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}
    fits = [k for k in kinds if low is None or -(1 << bits[type(k)]) <= low and high < 1 << bits[type(k)]]
    return fits[0].simpleString()


@dataclass(frozen=True)
class Change:
    column: str
    table_type: str | None
    new_type: str | None
    merged_type: str | None
    change: str


def merged_schema(table: T.StructType, new: T.StructType) -> tuple[T.StructType, list[Change]]:
    """A schema that holds rows of both, in the table's order with new columns at the
    end, and what differs. Names are compared without regard to case. A column in
    conflict keeps the table's type."""
    have, come = {f.name.lower(): f for f in table}, {f.name.lower(): f for f in new}
    fields, changes = [], []
    for key in [*have, *[k for k in come if k not in have]]:
        a, b = have.get(key), come.get(key)
        if a is None or b is None:
            only = a or b
            fields.append(T.StructField(only.name, only.dataType, True))
            kind = only.dataType.simpleString()
            changes.append(Change(only.name, a and kind, b and kind, kind, MISSING if a else ADDED))
            continue
        wide = widest(a.dataType, b.dataType)
        change = CONFLICT if wide is None else SAME if a.dataType == b.dataType else NARROWER if wide == a.dataType else WIDENED
        fields.append(T.StructField(a.name, wide or a.dataType, a.nullable or b.nullable))
        changes.append(Change(
            a.name, a.dataType.simpleString(), b.dataType.simpleString(), wide.simpleString() if wide is not None else None, change,
        ))
    return T.StructType(fields), changes


class DriftError(ValueError):
    """The new rows do not fit the table; ``changes`` says which columns differ and how."""

    def __init__(self, refused: list[Change], changes: list[Change]):
        super().__init__("; ".join(f"{c.column}: {c.change} ({c.table_type} -> {c.new_type})" for c in refused))
        self.refused, self.changes = refused, changes


def append_evolving(
    table: Snapshots, df: DataFrame, allow: Collection[str] = (SAME, ADDED, MISSING, WIDENED, NARROWER),
    transaction: tuple[str, int] | None = None,
) -> tuple[Version, list[Change]]:
    """Append rows; the table takes new columns and wider types, and no file is rewritten:
    older parts are cast as they are read. A change that is not allowed is refused
    before anything is written, and a conflict always is."""
    now = table.version()
    schema, changes = merged_schema(now.struct(), df.schema) if now else (df.schema, [])
    refused = [c for c in changes if c.change not in allow or c.change == CONFLICT]
    if refused:
        raise DriftError(refused, changes)
    by_key = {c.lower(): c for c in df.columns}
    rows = df.selectExpr(*[f"{name(by_key[f.name.lower()])} as {name(f.name)}" for f in schema if f.name.lower() in by_key])
    part = table.stage(rows)
    number = len(now.parts) if now else 0
    parts = {**(now.parts if now else {}), f"append/{number}": part}
    return table.publish(parts, schema, (), now, transaction), changes


def changes_frame(spark, changes: list[Change]) -> DataFrame:
    """The report as a frame; as many rows as columns."""
    return spark.createDataFrame(
        [(c.column, c.table_type, c.new_type, c.merged_type, c.change) for c in changes],
        "column_name string, table_type string, new_type string, merged_type string, change string",
    )
