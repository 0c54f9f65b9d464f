"""Types that hold the values of others, and casts to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every type holds the values of those before it. A long beyond 2^53 loses digits as
# a double, as SQL has it.
LADDER = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType()]


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that both can be cast to without losing their meaning."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if a in LADDER and b in LADDER:
        i, j = sorted((LADDER.index(a), LADDER.index(b)))
        if LADDER[j] == T.FloatType() and i >= LADDER.index(T.IntegerType()):
            j += 1  # a float has too few digits for an integer
        return LADDER[j]
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(min(38, whole + scale), scale)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return widened([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType), a.containsNull or b.containsNull)
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    times = {T.DateType(), T.TimestampType(), T.TimestampNTZType()}
    if {a, b} <= times:
        return T.TimestampType() if T.TimestampType() in (a, b) else T.TimestampNTZType()
    return T.StringType()


def widened(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns of the schemas, in order of first appearance, each as wide as it has to be."""
    names: dict[str, str] = {}
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema:
            low = field.name.lower()
            names.setdefault(low, field.name)
            types[low] = wider(types[low], field.dataType) if low in types else field.dataType
    return T.StructType([T.StructField(names[low], types[low], True) for low in names])


def as_type(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """``column`` of type ``have`` as ``want``, nested fields by name."""
    if have == want:
        return column
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name.lower(): f for f in have}
        fields = [
            as_type(column[own[f.name.lower()].name], own[f.name.lower()].dataType, f.dataType).alias(f.name)
            if f.name.lower() in own
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in want
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(column, lambda x: as_type(x, have.elementType, want.elementType))
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(column)
    return column.cast(want)
