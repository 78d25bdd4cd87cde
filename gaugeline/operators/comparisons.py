"""A reading against its neighbours in time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.times import DAY_MS
from gaugeline.functions.values import relative_change
from gaugeline.operators.slices import with_neighbours


def ring_ratio(
    series: DataFrame, key: Sequence[str] = ("id",), step: int = 1, tolerance: float = 0.1
) -> DataFrame:
    """Every reading as predecessor ``v2`` of the one exactly ``step`` later (NULL if there is none).

    ``ring_ratio`` is the change to three digits and ``is_ok`` tells whether it stays within
    the tolerance; both are NULL without a successor or after a zero. ``series`` is unique on
    ``(key, t)``, so each row has at most one successor. ``key=()`` compares across points by time
    only and then needs ``series`` to be unique on ``t``.
    """
    others = [c for c in series.columns if c not in (*key, "t", "v")]
    # Every row takes part twice, as itself and as predecessor at its successor's time; both meet in one aggregate. A row
    # without key or time has no successor, so its predecessor side stands alone (with equal rows, which are counted) and its
    # own side is left out.
    lone = reduce(or_, [F.col(c).isNull() for c in (*key, "t")])
    row = F.when(lone, F.struct("t", "v", *others))
    sides = F.array(
        F.struct(F.col("t").alias("at"), F.lit(False).alias("earlier"), F.when(F.lit(False), row).alias("apart")),
        F.struct((F.col("t") + step).alias("at"), F.lit(True).alias("earlier"), row.alias("apart")),
    )
    both = series.withColumn("_side", F.explode(sides)).filter(F.col("_side.earlier") | ~lone)
    earlier = F.col("_side.earlier")
    met = both.groupBy(*key, F.col("_side.at").alias("t"), F.col("_side.apart").alias("_apart")).agg(
        *[F.max(F.when(~earlier, F.col(c))).alias(c) for c in ("v", *others)],
        F.max(F.when(earlier, F.col("v"))).alias("v2"),
        F.max(earlier).alias("_earlier"),
        F.count("*").alias("_n"),
    )
    times = F.when(F.col("_apart").isNull(), 1).otherwise(F.col("_n")).cast("int")
    ratio = F.round(relative_change(F.col("v"), F.col("v2")), 3)
    return (
        met.filter("_earlier")
        .withColumn("_time", F.explode(F.array_repeat(F.lit(0), times)))
        .select(*key, "t", *[c for c in series.columns if c not in (*key, "t")], "v2")
        .withColumn("t", F.when(F.col("v").isNotNull(), F.col("t")))
        .withColumn("ring_ratio", ratio)
        .withColumn("is_ok", F.col("ring_ratio").between(-tolerance, tolerance))
    )


def split_ratio(compared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(normal, abnormal); pairs without a verdict are in neither."""
    return compared.filter("is_ok"), compared.filter("NOT is_ok")


def previous_reading(
    series: DataFrame,
    key: Sequence[str] = ("id",),
    later: bool = False,
    slice_ms: int = DAY_MS,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Nearest earlier reading, ``(0, 0)`` for the first; the later side only if asked for."""
    out = with_neighbours(series, key, slice_ms=slice_ms, cuts=cuts)
    zero_t, zero_v = F.lit(0).cast("bigint"), F.lit(0.0)
    after_t, after_v = zero_t, zero_v
    if later:
        after_t = F.coalesce(F.col("after")["t"], zero_t)
        after_v = F.coalesce(F.col("after")["v"], zero_v)
    return out.select(
        *series.columns,
        F.coalesce(F.col("before")["t"], zero_t).alias("previous_t"),
        F.coalesce(F.col("before")["v"], zero_v).alias("previous_v"),
        after_t.alias("next_t"),
        after_v.alias("next_v"),
    )


def neighbour_diff(
    series: DataFrame, key: Sequence[str] = ("id",), slice_ms: int = DAY_MS, cuts: DataFrame | None = None
) -> DataFrame:
    """Change toward the later and from the earlier reading, a row per side that exists."""
    sides = F.array(
        F.struct(F.lit("later").alias("side"), (F.col("after")["v"] - F.col("v")).alias("diff")),
        F.struct(F.lit("earlier").alias("side"), (F.col("v") - F.col("before")["v"]).alias("diff")),
    )
    return (
        with_neighbours(series, key, slice_ms=slice_ms, cuts=cuts)
        .select(*series.columns, F.inline(sides))
        .filter("diff IS NOT NULL")
    )


def lag_windowed(
    windows: DataFrame,
    key: Sequence[str] = ("point_id",),
    order: str = "window_start",
    value: str = "last_v",
    slice_ms: int = DAY_MS,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Adds ``previous_<value>``, the value of the point's window before."""
    out = with_neighbours(windows, key, order, [value], slice_ms, cuts)
    return out.select(*windows.columns, F.col("before")[value].alias(f"previous_{value}"))
