"""The narrowest type that holds all values of a column whose sources have different types."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole numbers and binary fractions from narrow to wide, decimal digits of whole numbers, and the
# whole numbers that doubles hold without a gap.
_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_DIGITS = (3, 5, 10, 19)
_BINARY = (T.FloatType(), T.DoubleType())
_TIMES = (T.DateType(), T.TimestampNTZType())
_SIMPLE = (T.StringType, T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
EXACT = 2**53
# Digits after the point that are tried for fractions, and the digits a decimal has.
SCALES, PRECISION = (0, 1, 2, 3, 4, 6, 8, 10, 12, 15, 18), 38


def _decimal(kinds: Iterable[T.DataType], scale: int) -> T.DataType:
    """A decimal for whole numbers and decimals, with at least ``scale`` digits after the point; text if none has room."""
    whole = 0
    for kind in kinds:
        if isinstance(kind, T.DecimalType):
            whole, scale = max(whole, kind.precision - kind.scale), max(scale, kind.scale)
        elif kind in _WHOLE:
            whole = max(whole, _DIGITS[_WHOLE.index(kind)])
    return T.DecimalType(whole + scale, scale) if whole + scale <= PRECISION else T.StringType()


def _pair(a: T.DataType | None, b: T.DataType | None) -> T.DataType | None:
    if a is None or b is None or a == b:
        return a if b is not None else None
    if a in _TIMES and b in _TIMES:
        return max(a, b, key=_TIMES.index)
    return T.StringType() if isinstance(a, _SIMPLE) and isinstance(b, _SIMPLE) else None


def common_type(kinds: Iterable[T.DataType], beyond: Callable[[], bool], scale: Callable[[], int | None]) -> T.DataType | None:
    """The narrowest type for the values of all; None where they have no form in common, such as a list and a number.

    Whole numbers, then decimals or doubles; dates, then times; else text. ``beyond`` says whether there are whole
    numbers that doubles do not hold, ``scale`` how many digits after the point the fractions need (None: more than a
    decimal has, or they are no numbers). Both are asked only if the answer hangs on them.
    """
    kinds = list(dict.fromkeys(kinds))
    numeric = all(k in _WHOLE or k in _BINARY or isinstance(k, T.DecimalType) for k in kinds)
    if len(kinds) < 2 or not numeric:
        return reduce(_pair, kinds)
    binary = [k for k in kinds if k in _BINARY]
    if not binary:
        return max(kinds, key=_WHOLE.index) if all(k in _WHOLE for k in kinds) else _decimal(kinds, 0)
    if any(isinstance(k, T.DecimalType) for k in kinds) or T.LongType() in kinds and beyond():
        digits = scale()
        exact = T.StringType() if digits is None else _decimal(kinds, digits)
        return T.DecimalType(PRECISION, exact.scale) if isinstance(exact, T.DecimalType) else exact
    return T.FloatType() if len(kinds) == 1 else T.DoubleType()


def lost(value: Column, kind: T.DataType, target: T.DataType) -> Column:
    """Whether a value does not come back equal from the target type."""
    return value.isNotNull() & ~F.coalesce(value.try_cast(target).try_cast(kind) == value, F.lit(False))


def scale_of(frame: DataFrame, column: str) -> int | None:
    """Digits after the point with which all fractions of a column come back equal; None if no decimal does it.

    Reads the column once; the whole part has the digits that are left.
    """
    kind, value = frame.schema[column].dataType, F.col(f"`{column}`")
    tried = [F.bool_or(lost(value, kind, T.DecimalType(PRECISION, s))).alias(f"s{s}") for s in SCALES]
    found = frame.agg(*tried).first()
    return next((s for s in SCALES if not found[f"s{s}"]), None)


def range_of(frame: DataFrame, column: str) -> tuple[int, int] | None:
    """Least and greatest value of a column of whole numbers; None without any."""
    found = frame.agg(F.min(f"`{column}`").alias("low"), F.max(f"`{column}`").alias("high")).first()
    return None if found.low is None else (found.low, found.high)


def is_beyond(span: tuple[int, int] | None) -> bool:
    return span is not None and (span[0] < -EXACT or span[1] > EXACT)
