"""Trailing moving average."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.functions.times import DAY_MS, floor_to


def moving_sums(
    series: DataFrame, window: int, sums: dict[str, Column], key: Sequence[str] = ("id",), part_ms: int = DAY_MS
) -> DataFrame:
    """For every row the sums of ``sums`` over the rows of its key, never NULL, in ``[t - window, t]``.

    A range frame re-adds the whole frame on every row. Here time is cut into blocks as
    long as the window. Such a window covers the rest of one block and the beginning of the next,
    so its sum is a running sum from the left of the row's own block plus a running sum from the
    right of the block before, whose rows take part shifted by one window. Both are one pass and
    nothing is subtracted.

    A block longer than ``part_ms`` is cut into parts of that length. Running sums stay inside a part; one row per part
    (the edge table) holds its totals, and running totals over the parts of a block are added to the rows. So a task's
    group is one part, at most ``part_ms`` distinct times twice, whatever the window.
    """
    names = list(sums)

    def place(shift: int) -> Column:
        at = F.col("t") + shift
        block = floor_to(at, window)
        part = block + floor_to(at - block, part_ms)
        return F.struct(block.alias("block"), part.alias("part"), at.alias("at"), F.lit(int(shift > 0)).alias("shifted"))

    placed = series.select(
        *key,
        F.struct(*[c for c in series.columns if c not in key], *[x.alias(f"_{n}") for n, x in sums.items()]).alias("_row"),
        F.explode(F.array(place(0), place(window))).alias("_p"),
    )
    placed = placed.select(*key, "_row", *[F.col(f"_p.{c}").alias(f"_{c}") for c in ("block", "part", "at", "shifted")])
    group = [*key, "_block", "_part"]
    dealt = placed.repartition(*group)
    rightward = Window.partitionBy(*group).orderBy("_at", "_shifted").rowsBetween(Window.unboundedPreceding, 0)
    # From the right, a shifted row at the same time comes first: the lower bound is inclusive.
    leftward = (
        Window.partitionBy(*group).orderBy(F.desc("_at"), F.desc("_shifted")).rowsBetween(Window.unboundedPreceding, 0)
    )
    own = F.col("_shifted") == 0
    value = {n: F.col("_row")[f"_{n}"] for n in names}
    rows = dealt.withColumns({f"_own_{n}": F.sum(F.when(own, value[n])).over(rightward) for n in names})
    rows = rows.withColumns({f"_rest_{n}": F.sum(F.when(~own, value[n])).over(leftward) for n in names})
    rows = rows.filter(own)
    parts = [f"_own_{n}" for n in names], [f"_rest_{n}" for n in names]
    if window > part_ms:
        # From the rows as they came: the totals combine before their own shuffle, a row per part and task.
        totals = placed.groupBy(*group).agg(
            *[F.sum(F.when(own, value[n])).alias(f"_left_{n}") for n in names],
            *[F.sum(F.when(~own, value[n])).alias(f"_right_{n}") for n in names],
        )
        of_block = Window.partitionBy(*key, "_block").orderBy("_part")
        left = of_block.rowsBetween(Window.unboundedPreceding, -1)
        right = of_block.rowsBetween(1, Window.unboundedFollowing)
        edges = totals.select(
            *group,
            *[F.sum(f"_left_{n}").over(left).alias(f"_left_{n}") for n in names],
            *[F.sum(f"_right_{n}").over(right).alias(f"_right_{n}") for n in names],
        )
        rows = rows.join(edges, group, "left")
        parts += [f"_left_{n}" for n in names], [f"_right_{n}" for n in names]
    zero = F.lit(0)
    return rows.select(
        *[F.col(c) if c in key else F.col("_row")[c].alias(c) for c in series.columns],
        *[reduce(add, [F.coalesce(c, zero) for c in of_name]).alias(n) for n, of_name in zip(names, zip(*parts))],
    )


def moving_avg(
    series: DataFrame,
    window: int = 60,
    key: Sequence[str] = ("id",),
    clamp_nonpositive: bool = False,
    marks: dict[str, Column] | None = None,
    part_ms: int = DAY_MS,
) -> DataFrame:
    """Adds ``moving_avg``, the mean of ``v`` over ``[t - window, t]``, both ends included.

    ``series`` is unique on ``(key, t)`` and ``v`` is never NULL. ``clamp_nonpositive`` gives 0 where
    the sum is not above zero. ``marks`` are further sums to keep (used by the stream). ``part_ms`` bounds what a
    task holds at once, see ``moving_sums``.
    """
    sums = {"_sum": F.col("v"), "_count": F.lit(1).cast("bigint"), **(marks or {})}
    out = moving_sums(series, window, sums, key, part_ms)
    mean = F.col("_sum") / F.col("_count")
    if clamp_nonpositive:
        mean = F.when(F.col("_sum") > 0, mean).otherwise(0.0)
    return out.withColumn("moving_avg", mean).drop("_sum", "_count")
