"""Times: epoch milliseconds (BIGINT) at the edges, TIMESTAMP inside."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_MS = 60_000
HOUR_MS = 3_600_000
DAY_MS = 86_400_000

# Length of a duration unit in milliseconds (a month is 30 days, a year 365).
UNIT_MS = {
    "ms": 1,
    "s": 1_000,
    "m": 60_000,
    "h": 3_600_000,
    "d": 86_400_000,
    "w": 604_800_000,
    "n": 2_592_000_000,
    "y": 31_536_000_000,
}

# Units of a window length such as ``1 minute``.
SPAN_MS = {"millisecond": 1, "second": 1_000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}

# Accepted written dates, by what they look like.
DATE_FORMATS = [
    (r"^\d{4}/\d{2}/\d{2}$", "yyyy/MM/dd"),
    (r"^\d{4}/\d{2}/\d{2} \d{2}:\d{2}$", "yyyy/MM/dd HH:mm"),
    (r"^\d{4}/\d{2}/\d{2}-\d{2}:\d{2}$", "yyyy/MM/dd-HH:mm"),
    (r"^\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}$", "yyyy/MM/dd HH:mm:ss"),
    (r"^\d{4}/\d{2}/\d{2}-\d{2}:\d{2}:\d{2}$", "yyyy/MM/dd-HH:mm:ss"),
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$", "yyyy-MM-dd HH:mm"),
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "yyyy-MM-dd HH:mm:ss"),
]


def ntz_millis(ts: Column) -> Column:
    """Epoch ms of a TIMESTAMP_NTZ column; cut, not rounded. The session's time zone must be UTC."""
    return F.unix_millis(ts.cast("timestamp"))


def event_time(t: Column) -> Column:
    return F.timestamp_millis(t)


def ingest_millis() -> Column:
    """Time of processing; one value per job or micro-batch."""
    return F.unix_millis(F.current_timestamp())


def formatted(t: Column) -> Column:
    return F.date_format(event_time(t), "yyyy-MM-dd HH:mm:ss")


def minute_text(t: Column) -> Column:
    return F.date_format(event_time(t), "yyyy-MM-dd HH:mm")


def day_text(t: Column) -> Column:
    return F.date_format(event_time(t), "yyyy-MM-dd")


def month_text(t: Column) -> Column:
    return F.date_format(event_time(t), "yyyyMM")


def floor_to(t: Column, step_ms: int) -> Column:
    """Largest multiple of ``step_ms`` not above ``t``."""
    return t - F.pmod(t, F.lit(step_ms))


def span_millis(length: str) -> int:
    """``"10 minutes"`` as milliseconds."""
    count, unit = length.split()
    return int(count) * SPAN_MS[unit.removesuffix("s")]


def duration_millis(text: Column) -> Column:
    """``10ms``, ``2m``, ``1n`` ... as milliseconds; NULL unless a positive number and a known unit."""
    number = F.regexp_extract(text, r"^(\d+)(?i:ms|s|m|h|d|w|n|y)$", 1).try_cast("bigint")
    unit = F.lower(F.regexp_extract(text, r"^\d+(?i:(ms|s|m|h|d|w|n|y))$", 1))
    factor = F.when(unit == "ms", F.lit(UNIT_MS["ms"]).cast("bigint"))
    for name, ms in UNIT_MS.items():
        factor = factor.when(unit == name, F.lit(ms).cast("bigint"))
    return F.when(number > 0, F.try_multiply(number, factor))


def time_millis(text: Column, zone: str = "UTC", now: Column | None = None) -> Column:
    """Epoch ms of a written time.

    Accepts ``123ms``, ``now``, ``5m-ago``, written dates (``DATE_FORMATS``), seconds of up to ten
    digits, milliseconds, and ``seconds.fraction``. Empty or NULL text gives -1, anything else NULL.
    """
    now = ingest_millis() if now is None else now
    lower = F.lower(text)
    ago = F.when(lower.endswith("-ago"), F.regexp_replace(lower, "-ago$", ""))
    result = (
        F.when(text.isNull() | (text == ""), F.lit(-1).cast("bigint"))
        .when(text.rlike(r"^\d+ms$"), F.regexp_replace(text, "ms$", "").try_cast("bigint"))
        .when(lower == "now", now)
        .when(lower.endswith("-ago"), now - duration_millis(ago))
    )
    for shape, fmt in DATE_FORMATS:
        wall = F.try_to_timestamp(F.when(text.rlike(shape), text), F.lit(fmt))
        result = result.when(text.rlike(shape), F.unix_millis(_from_zone(wall, zone)))
    seconds = text.try_cast("bigint")
    return (
        result.when(text.rlike(r"^\d{1,10}$"), seconds * 1000)
        .when(text.rlike(r"^\d{11,19}$"), seconds)
        .when(text.rlike(r"^\d{10}\.\d{1,3}$"), F.replace(text, F.lit("."), F.lit("")).try_cast("bigint"))
    )


def _from_zone(wall: Column, zone: str) -> Column:
    return wall if zone == "UTC" else F.to_utc_timestamp(wall, zone)


def interval_start(t: Column, count: int, unit: str, zone: str = "UTC") -> Column:
    """Start (epoch ms) of the aligned interval of ``count`` units that holds ``t``.

    An interval that divides its parent unit counts from there; another one starts anew at the top
    of the next larger unit (minute for ms, hour for s, day for m, month for h, year for d).
    Weeks always start on Sunday and years on 1 January, whatever ``count``. The session's time zone
    must be UTC; ``zone`` names the calendar.
    """
    if count < 1:
        raise ValueError("count must be at least 1")
    moment = event_time(t)
    wall = moment if zone == "UTC" else F.from_utc_timestamp(moment, zone)

    def at(local: Column) -> Column:
        return F.unix_millis(_from_zone(local, zone))

    # Parent unit of each clock unit, how many fit into it, and the parent used otherwise.
    clock = {
        "ms": (1_000, "second", "minute"),
        "s": (60, "minute", "hour"),
        "m": (60, "hour", "day"),
        "h": (24, "day", "month"),
    }
    if unit in clock:
        per_parent, parent, larger = clock[unit]
        base = at(F.date_trunc(parent if per_parent % count == 0 else larger, wall))
        return base + floor_to(t - base, count * UNIT_MS[unit])
    day = F.to_date(wall)
    if unit == "d":
        into = F.dayofmonth(day) - 1 if count == 1 else F.dayofyear(day) - 1
        return at(F.date_sub(day, (into % count).cast("int")).cast("timestamp"))
    if unit == "w":
        return at(F.date_sub(day, F.dayofweek(day) - 1).cast("timestamp"))
    year = F.trunc(day, "year")
    if unit == "n":
        back = (F.month(day) - 1) - (F.month(day) - 1) % count
        return at(F.add_months(year, back).cast("timestamp"))
    if unit == "y":
        return at(year.cast("timestamp"))
    raise ValueError(f"unknown unit {unit!r}")


def hour_floor(t: Column) -> Column:
    """Hour number in hundreds of seconds, so that consecutive hours differ by 36; -1 stays -1."""
    return F.when(t == -1, F.lit(-1).cast("bigint")).otherwise(
        (floor_to(t, HOUR_MS) / 100_000).cast("bigint")
    )


def hour_ceiling(t: Column) -> Column:
    """As ``hour_floor``, next hour unless the *second* of ``t`` is the top of an hour."""
    second = floor_to(t, 1_000)
    up = floor_to(second + (HOUR_MS - 1_000), HOUR_MS)
    return F.when(t == -1, F.lit(-1).cast("bigint")).otherwise((up / 100_000).cast("bigint"))


def hour_offset(t: Column) -> Column:
    """Milliseconds since the top of the hour."""
    return F.pmod(t, F.lit(HOUR_MS)).cast("bigint")


def from_hour(hour: Column, offset: Column) -> Column:
    return hour * 100_000 + offset


def month_start(day: Column, months: int) -> Column:
    """Epoch ms of the start of the month ``months`` away from that of ``day``."""
    return F.unix_millis(F.add_months(F.trunc(day, "month"), months).cast("timestamp"))


def past_day_start(t: Column, days: int) -> Column:
    """Midnight of the day ``days`` before that of ``t`` (session time zone)."""
    return F.unix_millis(F.date_sub(F.to_date(event_time(t)), days).cast("timestamp"))


def millis_between(start_text: Column, end_text: Column) -> Column:
    """Difference of two ``yyyy-MM-dd HH:mm:ss`` texts; an unreadable one counts as 0."""

    def read(text: Column) -> Column:
        ms = F.unix_millis(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")))
        return F.coalesce(ms, F.lit(0).cast("bigint"))

    return read(end_text) - read(start_text)


def stored_between(stored: Column, start: Column, stop: Column) -> Column:
    """``start <= epoch ms < stop`` of a stored TIMESTAMP_NTZ, as a range of the column itself: with constant ends it reaches
    the file scan, which a range of the milliseconds derived from it does not."""
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    first, last = (F.timestamp_add("MILLISECOND", x.cast("bigint"), zero) for x in (start, stop))
    return (stored >= first) & (stored < last)
