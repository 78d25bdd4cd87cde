"""Arithmetic on doubles as their decimal texts say, so that 0.1 + 0.2 is 0.3.

A double is the whole number of its digits (17 at most) times a power of ten. Results are formed
on whole numbers in DECIMAL and turned back by that power, so any double is taken as it is written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DIVISION_SCALE = 10  # fixed value: digits kept by a division
# Fixed value: powers of ten that a number of 17 digits can be multiplied by within 38 digits.
ROOM = 36


def _parts(x: Column) -> tuple[Column, Column]:
    """Digits as a whole number, and the power of ten they are multiplied by; NULL for NaN and infinities."""
    text = x.cast("double").cast("string")
    mantissa = F.substring_index(text, "E", 1)
    power = F.when(text.contains("E"), F.substring_index(text, "E", -1)).otherwise("0").try_cast("int")
    fraction = F.regexp_replace(F.substring_index(mantissa, ".", -1), "0+$", "")
    whole = F.substring_index(mantissa, ".", 1)
    return F.concat(whole, fraction).try_cast("decimal(18,0)"), power - F.length(fraction)


def _ten(power: Column) -> Column:
    """Ten to a power of 0 or more; NULL for NULL."""
    return F.rpad(F.lit("1"), power + 1, F.lit("0")).cast("decimal(38,0)")


def _double(digits: Column, power: Column) -> Column:
    return F.concat(digits.cast("decimal(38,0)").cast("string"), F.lit("E"), power.cast("string")).cast("double")


def _scaled(digits: Column, power: Column) -> Column:
    return (digits.cast("decimal(18,0)") * _ten(power)).cast("decimal(38,0)")


def _short(x: Column) -> Column:
    """The number as a small DECIMAL where that is all its digits say, else NULL: most numbers, at little cost."""
    number = x.cast("double")
    decimal = number.try_cast("decimal(15,6)")
    return F.when(decimal.cast("double") == number, decimal)


def _either(short: Column, wide: Callable[[Column, Column], Column], a: Column, b: Column) -> Column:
    """``short``, and ``wide(a, b)`` where that is NULL.

    The wide form is rare and long. As a function over an array of one pair it is evaluated only where it is needed and
    stays out of the generated code, which would otherwise outgrow the 64 KB that a method may have.
    """
    pair = F.array(F.struct(a.cast("double").alias("a"), b.cast("double").alias("b")))
    return F.coalesce(short, F.transform(pair, lambda p: wide(p["a"], p["b"]))[0])


def _wide_sum(a: Column, b: Column, sign: int) -> Column:
    (m, e), (n, f) = _parts(a), _parts(b)
    n = n * F.lit(sign)
    low, high = F.least(e, f), F.greatest(e, f)
    digits = F.length(F.abs(F.when(e >= f, m).otherwise(n)).cast("string"))
    near = digits + high - low <= ROOM
    up = [F.when(near, power - low) for power in (e, f)]
    exact = _double((_scaled(m, up[0]) + _scaled(n, up[1])).cast("decimal(38,0)"), low)
    # Beyond the room the number of the lower power is far below the last digit of the other one.
    larger = F.when(m == 0, _double(n, f)).when(n == 0, _double(m, e)).when(e > f, _double(m, e)).otherwise(_double(n, f))
    plain = a.cast("double") + b.cast("double") * F.lit(float(sign))
    return F.when(m.isNull() | n.isNull(), plain).when(near, exact).otherwise(larger)


def _sum(a: Column, b: Column, sign: int) -> Column:
    short = _short(a) + _short(b) if sign > 0 else _short(a) - _short(b)
    return _either(short.cast("double"), lambda x, y: _wide_sum(x, y, sign), a, b)


def add(a: Column, b: Column) -> Column:
    return _sum(a, b, 1)


def subtract(a: Column, b: Column) -> Column:
    return _sum(a, b, -1)


def _wide_product(a: Column, b: Column) -> Column:
    (m, e), (n, f) = _parts(a), _parts(b)
    product = _double((m.cast("decimal(18,0)") * n.cast("decimal(18,0)")).cast("decimal(38,0)"), e + f)
    return F.when(m.isNull() | n.isNull(), a.cast("double") * b.cast("double")).otherwise(product)


def multiply(a: Column, b: Column) -> Column:
    return _either((_short(a) * _short(b)).cast("double"), _wide_product, a, b)


def divide(a: Column, b: Column, digits: int = DIVISION_SCALE) -> Column:
    """Quotient rounded HALF_UP to ``digits`` after the point; NULL when ``b`` is zero.

    A quotient of so many digits that a double cannot hold them all is the double next to it.
    """
    if digits < 0:
        raise ValueError("digits must be 0 or more")
    # A dividend of such a precision gives Spark's quotient exactly ``digits``, rounded once.
    room = 38 - digits
    short = F.lit(None).cast("double")
    if 6 <= digits <= 20:
        short = (_short(a).cast(f"decimal({room},6)") / F.nullif(_short(b), F.lit(0))).cast("double")
    return _either(short, lambda x, y: _wide_quotient(x, y, digits), a, b)


def _wide_quotient(a: Column, b: Column, digits: int) -> Column:
    (m, e), (n, f) = _parts(a), _parts(b)
    power = e - f + digits
    # Digits of the quotient as a whole number; a double doesn't hold more than 17 of them.
    length = F.length(F.abs(m).cast("string")) + power - F.length(F.abs(n).cast("string"))
    near = (length <= 19) & (power >= -18)
    top = F.abs(_scaled(m, F.when(near, F.greatest(power, F.lit(0)))))
    under = F.abs(_scaled(n, F.when(near, F.greatest(-power, F.lit(0)))))
    # Exact: the dividend less its rest, and one more where twice the rest reaches the divisor.
    rest = (top % under).cast("decimal(38,0)")
    count = ((top - rest).cast("decimal(38,0)") / under.cast("decimal(38,0)")).cast("decimal(30,0)")
    count = count + F.when(rest >= under - rest, 1).otherwise(0)
    sign = F.when((m < 0) != (n < 0), -1).otherwise(1)
    exact = _double(count * sign, F.lit(-digits))
    plain = F.try_divide(a.cast("double"), b.cast("double"))
    return (
        F.when(b.cast("double") == 0, F.lit(None).cast("double"))
        .when(m.isNull() | n.isNull() | (length > 19), plain)
        .when(power < -18, F.lit(0.0))
        .otherwise(exact)
    )
