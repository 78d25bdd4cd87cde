"""Ordered-per-point work without putting a whole point into one task.

``Window.partitionBy(point)`` sends all readings of a point to one task, and one busy point may hold
a third of all rows. So a point's time line is cut into slices of fixed length. Readings are unique
per ``(point, t)``, hence a slice holds at most ``slice_ms`` of them. Windows run inside slices; what
has to cross a slice border travels in an *edge table* with one row per slice, whose size per
point is bounded by the covered time, not by the number of readings. It is joined back on the same
keys the windows are partitioned by, so the readings are not shuffled again.

The slices are placed by an explicit ``repartition``. A window over ``(point, slice)`` would be content
with rows that happen to be partitioned by point alone, which is what slices are to avoid.

A point that is read a thousand times a second has 86 million readings a day. ``dense_cuts`` finds the slices that hold too
many and where to cut them; ``with_slice`` and what is built on it take these cuts. Slices may then differ in length, which
nothing depends on.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.functions.times import DAY_MS, MINUTE_MS, floor_to
from gaugeline.session import shared_folder
from gaugeline.sources.rules import lookup

SLICE = "slice_start"
# Most readings of a slice, but for those of one more cell.
SLICE_ROWS = 1_000_000


def first_arrivals(
    readings: DataFrame,
    keys: Sequence[str] = ("id", "t"),
    order: str = "seq",
    values: Sequence[str] = ("v",),
) -> DataFrame:
    """One row per key: the values of the row with the lowest ``order`` (unique within a key).

    An aggregate rather than ``row_number``, so copies collapse before the shuffle; with numeric
    ``values`` it is a hash aggregate.
    """
    picked = [F.min_by(c, order).alias(c) for c in values]
    return readings.groupBy(*keys).agg(F.min(order).alias(order), *picked)


def dense_cuts(
    series: DataFrame,
    key: Sequence[str] = ("id",),
    t: str = "t",
    slice_ms: int = DAY_MS,
    cell_ms: int = MINUTE_MS,
    most: int = SLICE_ROWS,
) -> DataFrame | None:
    """Where slices of more than ``most`` readings are cut, or None if there is no such slice.

    One row per dense slice: ``_slice`` (key and start) and ``_cuts``, the ordered starts of its pieces. Readings are counted
    by cell of ``cell_ms`` (which should divide ``slice_ms``); a piece ends with the cell in which a multiple of ``most`` is
    reached, so it holds less than ``most`` readings and those of one cell, however bursty the slice is. The counts combine
    before the shuffle, and a slice has ``slice_ms / cell_ms`` cells. There are at most two cuts per ``most`` readings.

    Copies of a reading count as well; take the cuts from first arrivals where there are many. Runs a job, and writes its
    result to the shared folder.
    """
    spark = series.sparkSession
    cells = (
        with_slice(series, t, slice_ms)
        .groupBy(F.struct(*key, SLICE).alias("_slice"), floor_to(F.col(t), cell_ms).alias("_cell"))
        .agg(F.count("*").alias("_n"))
    )
    of_slice = Window.partitionBy("_slice")
    before = of_slice.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counted = cells.withColumns(
        {"_all": F.sum("_n").over(of_slice), "_before": F.coalesce(F.sum("_n").over(before), F.lit(0))}
    )
    pieces = (
        counted.filter(F.col("_all") > most)
        .groupBy("_slice", F.floor(F.col("_before") / most).alias("_piece"))
        .agg(F.min("_cell").alias("_start"))
    )
    path = shared_folder(spark, "cuts")
    cuts = pieces.groupBy("_slice").agg(F.array_sort(F.collect_list("_start")).alias("_cuts"))
    cuts.write.parquet(path)
    cuts = spark.read.schema(cuts.schema).parquet(path)
    return None if cuts.isEmpty() else cuts


def with_slice(
    series: DataFrame,
    t: str = "t",
    slice_ms: int = DAY_MS,
    cuts: DataFrame | None = None,
    key: Sequence[str] = ("id",),
) -> DataFrame:
    """Adds the start of the slice of each row; with ``cuts`` (see ``dense_cuts``, same ``key`` and ``slice_ms``) of its piece.

    Cuts are broadcast if proven small, else joined with the rows of a slice spread over parts.
    """
    sliced = series.withColumn(SLICE, floor_to(F.col(t), slice_ms))
    if cuts is None:
        return sliced
    found = lookup(sliced, cuts, F.struct(*key, SLICE), "_slice", "left")
    # A row before the first cut does not occur where the cuts are those of these rows; for others the slice begins there.
    piece = F.array_max(F.filter("_cuts", lambda start: start <= F.col(t)))
    return found.withColumn(SLICE, F.coalesce(piece, SLICE)).drop("_slice", "_cuts")


def with_neighbours(
    series: DataFrame,
    key: Sequence[str] = ("id",),
    t: str = "t",
    values: Sequence[str] = ("v",),
    slice_ms: int = DAY_MS,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Adds ``before`` and ``after``: structs of ``t`` and ``values`` of the neighbouring rows.

    ``series`` must be unique on ``(key, t)`` and ``key`` never NULL. NULL where there is no
    neighbour. ``cuts`` are those of dense slices, see ``dense_cuts``.
    """
    part = [*key, SLICE]
    in_slice = Window.partitionBy(*part).orderBy(t)
    # One struct per row, so that both uses below read the same columns and share one shuffle.
    others = [c for c in series.columns if c not in key]
    present = series.filter(reduce(and_, [F.col(k).isNotNull() for k in key]))
    packed = with_slice(present, t, slice_ms, cuts, key).select(*part, t, F.struct(*others).alias("_row"))
    packed = packed.repartition(*part)
    point = F.struct(t, *[F.col("_row")[c].alias(c) for c in values])
    rows = packed.withColumns(
        {"_lag": F.lag(point).over(in_slice), "_lead": F.lead(point).over(in_slice)}
    )
    # First and last row of a slice, column by column: with plain numbers this is a hash aggregate
    # on rows that lie together already, without a sort.
    ends = {"first": (F.min, F.min_by), "last": (F.max, F.max_by)}
    edges = packed.groupBy(*part).agg(
        *[
            agg
            for name, (extreme, by) in ends.items()
            for agg in (
                extreme(t).alias(f"_{name}_{t}"),
                *[by(F.col("_row")[c], t).alias(f"_{name}_{c}") for c in values],
            )
        ]
    )
    first, last = (
        F.struct(*[F.col(f"_{name}_{c}").alias(c) for c in (t, *values)]) for name in ends
    )
    across = Window.partitionBy(*key).orderBy(SLICE)
    edges = edges.select(
        *part,
        F.lag(last).over(across).alias("_before_slice"),
        F.lead(first).over(across).alias("_after_slice"),
    )
    return rows.join(edges, part, "left").select(
        *[F.col(c) if c in key else F.col("_row")[c].alias(c) for c in series.columns],
        F.coalesce("_lag", "_before_slice").alias("before"),
        F.coalesce("_lead", "_after_slice").alias("after"),
    )
