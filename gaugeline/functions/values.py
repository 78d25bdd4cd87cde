"""Typed values and row-level checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_value(raw: Column) -> Column:
    """``B#true`` -> 1, any other ``B#`` -> 0, ``F#1.5`` -> 1.5, no ``#`` -> the number itself.

    What is not a number becomes NULL, so one bad message cannot fail the job.
    """
    body = F.substr(raw, F.lit(3))
    return (
        F.when(raw.contains("B#"), F.when(body == "true", 1.0).otherwise(0.0))
        .when(raw.contains("#"), body.try_cast("double"))
        .otherwise(raw.try_cast("double"))
    )


def is_string_value(raw: Column) -> Column:
    return raw.contains("S#")


def value_type(raw: Column) -> Column:
    """Type letter of a prefixed value."""
    return F.substr(raw, F.lit(1), F.lit(1))


def strip_prefix(raw: Column, n: int) -> Column:
    """The text without its first ``n`` characters."""
    return F.substr(raw, F.lit(n + 1))


def less(a: Column, b: Column) -> Column:
    """``a < b`` as numbers: false where one of them is NaN, which Spark orders above all others."""
    return (a < b) & ~F.isnan(a) & ~F.isnan(b)


def limit_ok(v: Column, lower: Column, upper: Column) -> Column:
    """Strictly between the bounds; NULL where a bound is missing or not a number."""
    return less(lower.try_cast("double"), v) & less(v, upper.try_cast("double"))


def limit_outside(v: Column, lower: Column, upper: Column) -> Column:
    """Beyond a bound. A value on the bound is not outside, though it is not ``limit_ok`` either."""
    return less(v, lower.try_cast("double")) | less(upper.try_cast("double"), v)


def switch_ok(v: Column, default: Column) -> Column:
    """Same whole number as the default position; both are cut toward zero.

    As whole numbers of 32 bits: what lies beyond becomes the nearest one, NaN becomes 0.
    """
    return _cut(v.try_cast("double")) == _cut(default.try_cast("double"))


def _cut(x: Column) -> Column:
    inside = F.greatest(F.least(x, F.lit(2147483647.0)), F.lit(-2147483648.0)).cast("int")
    return F.when(x.isNull(), None).when(F.isnan(x), 0).otherwise(inside)


def relative_change(v: Column, before: Column) -> Column:
    """``(v - before) / before``, NULL when ``before`` is zero."""
    return F.try_divide(v - before, before)
