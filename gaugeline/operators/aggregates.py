"""Values per time window. Every aggregate combines before the shuffle, so a busy point costs a
shuffle row per window and task, not per reading. All work on streams too, except ``sliding_last``,
whose stream form is ``sliding_last_stream``."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.times import day_text, event_time, floor_to, span_millis
from gaugeline.operators.slices import with_neighbours


def with_event_time(readings: DataFrame) -> DataFrame:
    return readings.withColumn("event_time", event_time(F.col("t")))


# What makes any BIGINT a tie of 0 or more, and what is above all such ties.
TIE_SHIFT = 2**63
TIE_ROOM = 10**20


def _latest(value: str, length_ms: int | None, tie: str | None) -> Column:
    """Value at the latest ``t`` of a window; among equal times at the highest ``tie``, a whole number.

    Ordering by a struct makes Spark sort the rows instead of hashing them (three times slower here), so
    place in the window and tie are packed into one DECIMAL, which holds any tie. A missing tie is the lowest.
    """
    if tie is None:
        return F.max_by(value, "t")
    if length_ms is None:  # windows that don't begin at multiples of their length
        return F.max_by(value, F.struct("t", tie))
    place = F.pmod(F.col("t"), F.lit(length_ms).cast("bigint")).cast("decimal(17,0)")
    tied = F.coalesce(F.col(tie).cast("bigint").cast("decimal(20,0)") + F.lit(Decimal(TIE_SHIFT)), F.lit(Decimal(0)))
    return F.max_by(value, (place * F.lit(Decimal(TIE_ROOM)) + tied).cast("decimal(38,0)"))


def _tumbling(
    readings: DataFrame, keys: Sequence[str], length: str, aggs: dict[str, Column]
) -> DataFrame:
    """``keys, window_start, window_end`` (epoch ms) and the aggregates."""
    length_ms = span_millis(length)
    if readings.isStreaming:  # the watermark needs Spark's own window
        grouped = readings.groupBy(*keys, F.window("event_time", length).alias("_w"))
        start = F.unix_millis("_w.start")
    else:
        grouped = readings.groupBy(*keys, floor_to(F.col("t"), length_ms).alias("_w"))
        start = F.col("_w")
    out = grouped.agg(*[a.alias(n) for n, a in aggs.items()])
    return out.select(
        *keys,
        start.alias("window_start"),
        (start + length_ms).alias("window_end"),
        *aggs,
    )


def window_last(
    readings: DataFrame,
    length: str = "1 minute",
    keys: Sequence[str] = ("uri",),
    tie: str | None = None,
) -> DataFrame:
    """Last value per window, labelled by the window's end (epoch ms)."""
    last = _latest("v", span_millis(length), tie)
    return _tumbling(readings, keys, length, {"v": last}).select(*keys, "v", F.col("window_end").alias("t"))


def window_avg(
    readings: DataFrame, length: str = "1 minute", keys: Sequence[str] = ("uri",)
) -> DataFrame:
    """Average per window, labelled by the window's end."""
    out = _tumbling(readings, keys, length, {"v": F.avg("v")})
    return out.select(*keys, "v", F.col("window_end").alias("t"))


def window_last_ingest(
    readings: DataFrame,
    length: str = "1 minute",
    keys: Sequence[str] = ("uri",),
    tie: str | None = None,
) -> DataFrame:
    """Last value per window together with the earliest ingest time ``st``."""
    last = _latest("v", span_millis(length), tie)
    out = _tumbling(readings, keys, length, {"v": last, "st": F.min("st")})
    return out.select(*keys, "v", F.col("window_end").alias("t"), "st")


def window_parts(
    readings: DataFrame, length: str, keys: Sequence[str], how: str, tie: str | None = None
) -> DataFrame:
    """Per window what ``merge_parts`` needs to put several points together, labelled by the window's end.

    ``avg``: ``sum_v, n``; ``last``: ``v`` and its place in time ``at``; ``last_ingest``: also ``st``.
    """
    last = {"v": _latest("v", span_millis(length), tie), "at": F.max("t")}
    aggs = {
        "avg": {"sum_v": F.sum("v"), "n": F.count("v")},
        "last": last,
        "last_ingest": {**last, "st": F.min("st")},
    }
    if how not in aggs:
        raise ValueError("how must be 'last', 'avg' or 'last_ingest'")
    out = _tumbling(readings, keys, length, aggs[how])
    return out.select(*keys, *aggs[how], F.col("window_end").alias("t"))


def merge_parts(parts: DataFrame, by: Sequence[str], how: str, order: Sequence[str] = ()) -> DataFrame:
    """``by`` and the value of all parts together; of equal times the part with the highest ``order`` counts."""
    if how == "avg":
        return parts.groupBy(*by).agg((F.sum("sum_v") / F.sum("n")).alias("v"))
    extra = [F.min("st").alias("st")] if how == "last_ingest" else []
    return parts.groupBy(*by).agg(F.max_by("v", F.struct("at", *order)).alias("v"), *extra)


def window_last_point(
    readings: DataFrame,
    length: str = "1 minute",
    keys: Sequence[str] = ("point_id",),
    tie: str | None = None,
) -> DataFrame:
    """Last value and its time per window and point, with the window and the day it starts in."""
    last = _latest("v", span_millis(length), tie)
    out = _tumbling(readings, keys, length, {"last_v": last, "last_t": F.max("t")})
    return out.withColumn("day", day_text(F.col("window_start")))


def window_running(
    readings: DataFrame,
    length: str = "1 minute",
    keys: Sequence[str] = ("id",),
    tie: str | None = None,
) -> DataFrame:
    """Sum, average and last value per point and window; on a stream in update mode, one row per
    window touched by the batch."""
    last = _latest("v", span_millis(length), tie)
    out = _tumbling(readings, keys, length, {"sum_v": F.sum("v"), "avg_v": F.avg("v"), "last_v": last})
    return out.drop("window_end")


def sliding_last(
    readings: DataFrame,
    keys: Sequence[str] = ("point_id",),
    window_ms: int = 60_000,
    slide_ms: int = 1_000,
    tie: str | None = None,
) -> DataFrame:
    """Last value and its time in every window ``[s, s + window_ms)``, ``s`` a multiple of the slide.

    ``window(ts, length, slide)`` copies each reading into every window holding it (60 for a
    minute by a second) and aggregates the copies. Instead, readings shrink to one row per slide
    first. A slide row is the last one of exactly those windows that end after it and no later than
    the next slide row, so it is expanded to just these: rows made equal rows returned.
    """
    if window_ms % slide_ms:
        raise ValueError("the window must be a whole number of slides")
    panes = (
        readings.groupBy(*keys, floor_to(F.col("t"), slide_ms).alias("pane"))
        .agg(_latest("v", slide_ms, tie).alias("last_v"), F.max("t").alias("last_t"))
    )
    linked = with_neighbours(panes, keys, "pane", ())
    final = F.col("pane") + slide_ms - window_ms  # the earliest window holding the pane starts here
    stop = F.least(F.col("pane"), F.coalesce(F.col("after")["pane"] - window_ms, F.col("pane")))
    starts = F.when(final <= stop, F.sequence(final, stop, F.lit(slide_ms).cast("bigint")))
    return linked.select(*keys, F.explode(starts).alias("window_start"), "last_v", "last_t")


def sliding_last_stream(
    readings: DataFrame,
    keys: Sequence[str] = ("point_id",),
    length: str = "1 minute",
    slide: str = "1 second",
    tie: str | None = None,
) -> DataFrame:
    """``sliding_last`` as one streaming aggregate."""
    out = (
        readings.groupBy(F.window("event_time", length, slide).alias("w"), *keys)
        .agg(_latest("v", None, tie).alias("last_v"), F.max("t").alias("last_t"))
    )
    return out.select(*keys, F.unix_millis("w.start").alias("window_start"), "last_v", "last_t")


def sliding_last_panes(
    readings: DataFrame,
    keys: Sequence[str] = ("point_id",),
    length: str = "1 minute",
    slide: str = "1 second",
    tie: str | None = None,
) -> DataFrame:
    """``sliding_last`` as two streaming aggregates: readings to one row per slide, these rows to windows.

    A reading meets the state once, in its slide, and not in each window that holds it; only slide rows are copied. Both
    aggregates let go of what the watermark passed, so their state is bounded. Needs a watermark on ``event_time`` and append
    mode; a window comes when the watermark passes its end. Equal times go to the highest ``tie``, a whole number.
    """
    slide_ms = span_millis(slide)
    panes = readings.groupBy(F.window("event_time", slide).alias("pane"), *keys).agg(
        _latest("v", slide_ms, tie).alias("last_v"), F.max("t").alias("last_t")
    )
    # A pane is over when the watermark passes its end, and stands for its last instant in the windows.
    out = panes.groupBy(F.window(F.window_time("pane"), length, slide).alias("w"), *keys).agg(
        F.max_by("last_v", "last_t").alias("last_v"), F.max("last_t").alias("last_t")
    )
    return out.select(*keys, F.unix_millis("w.start").alias("window_start"), "last_v", "last_t")
