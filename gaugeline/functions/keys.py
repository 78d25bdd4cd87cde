"""Row keys of the keyed store."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layout of the row key.
SALT_DIGITS = 2
TIME_DIGITS = 13  # epoch milliseconds
CUT_DIGITS = 4  # minute values end in at least four zeros


def java_hash(text: Column) -> Column:
    """The 32-bit string hash of the JVM (``s[0]*31^(n-1) + ... + s[n-1]``), as BIGINT.

    The hash runs over UTF-16 units, so the text is taken apart as UTF-16 rather than characters.
    """
    units = F.hex(F.encode(text, "UTF-16BE"))
    count = F.char_length(text.cast("string"))
    starts = F.when(count > 0, F.sequence(F.lit(1), F.length(units), F.lit(4)))
    total = F.aggregate(
        F.transform(starts, lambda i: F.conv(F.substr(units, i, F.lit(4)), 16, 10).cast("bigint")),
        F.lit(0).cast("bigint"),
        lambda acc, unit: F.pmod(acc * 31 + unit, F.lit(4294967296)),
    )
    signed = F.when(total >= 2147483648, total - 4294967296).otherwise(total)
    return F.when(text.isNotNull(), F.coalesce(signed, F.lit(0).cast("bigint")))


def salt(uri: Column, regions: int) -> Column:
    """Region number in ``[0, regions)``; at most 100 so that two digits suffice."""
    if not 1 <= regions <= 100:
        raise ValueError("regions must lie in 1..100")
    return (F.abs(java_hash(uri)) % regions).cast("int")


def row_key(uri: Column, t: Column, salt_value: Column) -> Column:
    """Two-digit salt, uri, and epoch ms without its last four digits."""
    text = F.concat(F.lpad(salt_value.cast("string"), SALT_DIGITS, "0"), uri, t.cast("string"))
    return F.left(text, F.char_length(text) - CUT_DIGITS)


def row_key_md5(uri: Column, t: Column) -> Column:
    return F.concat(F.md5(F.encode(uri, "UTF-8")), t.cast("string"))


def row_key_time(key: Column) -> Column:
    """Epoch ms back from a salted row key; 0 where the key does not end in a time."""
    digits = F.right(key, F.lit(TIME_DIGITS - CUT_DIGITS))
    return F.coalesce(digits.try_cast("bigint") * (10**CUT_DIGITS), F.lit(0).cast("bigint"))
