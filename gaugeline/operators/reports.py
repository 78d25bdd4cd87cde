"""Jobs over time columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions import times


def interval_rollup(
    readings: DataFrame, count: int, unit: str, keys: Sequence[str] = ("id",), zone: str = "UTC"
) -> DataFrame:
    """Count, sum, lowest and highest value per aligned interval."""
    start = times.interval_start(F.col("t"), count, unit, zone)
    return readings.groupBy(*keys, start.alias("interval_start")).agg(
        F.count("v").alias("n"),
        F.sum("v").alias("sum_v"),
        F.min("v").alias("min_v"),
        F.max("v").alias("max_v"),
    )


def hour_rollup(readings: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Readings per hour number, with the first and last offset inside the hour."""
    t = F.col("t")
    return (
        readings.groupBy(*keys, times.hour_floor(t).alias("hour"))
        .agg(
            F.count("v").alias("n"),
            F.min(times.hour_offset(t)).alias("first_offset"),
            F.max(times.hour_offset(t)).alias("last_offset"),
            F.max(times.hour_ceiling(t)).alias("next_hour"),
        )
        .withColumn("first_t", times.from_hour(F.col("hour"), F.col("first_offset")))
        .withColumn("month", times.month_text(F.col("first_t")))
    )


def past_day(readings: DataFrame, reference: Column, days: int) -> DataFrame:
    """Readings of the day ``days`` before ``reference`` (epoch ms), with that day's marks.

    ``reference`` is a constant, so the range is one too. It reaches the file scan where ``t`` is stored; where it is derived
    from a stored time, filter that one by ``times.stored_between`` first.
    """
    start = times.past_day_start(reference, days)
    end = start + times.DAY_MS - 1
    return readings.filter(F.col("t").between(start, end)).select(
        "*",
        start.alias("day_start"),
        (start + 12 * times.HOUR_MS).alias("day_noon"),
        end.alias("day_end"),
        (reference - days * times.DAY_MS).alias("same_time"),
    )
