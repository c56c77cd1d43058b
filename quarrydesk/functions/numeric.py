"""Numeric expressions that keep NULL as NULL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(value: Column) -> Column:
    return F.when(F.isnan(value), F.lit(None)).otherwise(value)


def clip(value: Column, low: float, high: float) -> Column:
    """Bound to [low, high]; NULL stays NULL (``least`` and ``greatest`` skip NULLs)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def pct(part: Column, whole: Column) -> Column:
    """Percentage, NULL for an empty whole."""
    return F.when(whole != 0, part * F.lit(100.0) / whole)


def dot(left: Column, right: Column) -> Column:
    """Dot product of two numeric arrays, accumulated in double."""
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    An expression used inside a lambda is otherwise evaluated per element.
    """
    return F.transform(F.array(value), body)[0]


def unit_vector(vector: Column) -> Column:
    """L2-normalise; an all-zero vector is returned unchanged."""
    return let(F.sqrt(dot(vector, vector)), lambda norm: F.transform(
        vector, lambda x: F.when(norm == 0, x.cast("double")).otherwise(x.cast("double") / norm)))


def one_decimal(value: Column) -> Column:
    """0..100 printed with one decimal, rounded on the exact binary value.

    ``format_string`` rounds the shortest decimal text half up, which differs
    on values such as 69.05. Scaling by 2**56 keeps the value exact.
    """
    unit = F.lit(1 << 56).cast("decimal(20,0)")
    tenths = (value * float(1 << 56)).cast("bigint").cast("decimal(20,0)") * F.lit(10).cast("decimal(2,0)")
    rest = tenths % unit
    whole = ((tenths - rest) / unit).cast("bigint")
    up = (rest * 2 > unit) | ((rest * 2 == unit) & (whole % 2 == 1))
    rounded = whole + up.cast("bigint")
    return F.concat(F.floor(rounded / 10).cast("string"), F.lit("."), (rounded % 10).cast("string"))
