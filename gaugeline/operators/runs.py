"""Abnormal runs: consecutive abnormal readings of a point.

Closed form. With ``prev`` the reading before, ``abnormal = rule(reading, prev)``. A run starts at an
abnormal reading whose predecessor is not abnormal, and ends at the first reading after its last
one; with no such reading it is open (NULL). So a run begins at the reading after the latest normal one, and at the point's
first reading if there is none: on every row, a running maximum. It carries over slice borders through the edge table
(see ``slices``), so a run may span any number of slices.

Any number of rules is judged in one pass: one placement, one sort and one edge table, with a flag per rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.functions.times import DAY_MS
from gaugeline.operators.changes import row_changes
from gaugeline.operators.discriminators import Discriminator
from gaugeline.operators.slices import SLICE, first_arrivals, with_slice


# ``seed`` of an evicted reading that was normal; an abnormal one carries the start of its run.
NORMAL_SEED = -1


def judge(
    series: DataFrame,
    rules: Sequence[Discriminator],
    key: Sequence[str] = ("id",),
    carry: Sequence[str] = ("uri",),
    slice_ms: int = DAY_MS,
    seeded: bool = False,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Judge a series that is unique on ``(key, t)``, where ``key`` is never NULL, by several rules at once.

    Needs ``t``, ``v`` and the rules' parameter columns; ``carry`` columns stay. Adds ``previous_value``, ``next_time`` and for
    rule number i ``abnormal_i``, ``start_i`` (the beginning of the run, on its rows) and ``is_last_i``. With ``seeded``, a
    non-NULL ``seed`` on the first reading of a point states its judgement instead of the rules (see ``streaming.incremental``).
    ``cuts`` are those of dense slices (see ``slices.dense_cuts``).
    """
    # One struct per reading: both uses of the shuffled rows then read the same columns, so Spark
    # shuffles them once (ReusedExchange).
    params = dict.fromkeys(p for rule in rules for p in rule.params)
    read = ["v", *params, *(["seed"] if seeded else []), *carry]
    part = [*key, SLICE]
    in_slice = Window.partitionBy(*part).orderBy("t")
    so_far = in_slice.rowsBetween(Window.unboundedPreceding, 0)
    c = F.col
    present = series.filter(reduce(and_, [c(k).isNotNull() for k in key]))
    numbers = range(len(rules))

    def judged(i: int, reading: Column, before: Column) -> Column:
        verdict = rules[i].abnormal(reading, before)
        if seeded:
            verdict = F.when(reading["seed"].isNotNull(), reading["seed"] >= 0).otherwise(verdict)
        return F.coalesce(reading["v"].isNotNull() & verdict, F.lit(False))

    # Inside a slice. The first row is not judged here: it looks beyond the border.
    narrow = present.select(*key, "t", F.struct(*read).alias("r"))
    placed = with_slice(narrow, "t", slice_ms, cuts, key).repartition(*part)
    rows = placed.withColumns(
        {"n": F.row_number().over(in_slice), "r1": F.lag("r").over(in_slice), "next_t": F.lead("t").over(in_slice)}
    ).withColumns({f"flag_{i}": F.when(c("n") > 1, judged(i, c("r"), c("r1"))) for i in numbers})
    rows = rows.withColumns(
        {f"next_flag_{i}": F.lead(f"flag_{i}").over(in_slice) for i in numbers}
        | {f"inner_{i}": F.max(F.when(~c(f"flag_{i}"), c("next_t"))).over(so_far) for i in numbers}
    )

    # One row per slice: its first and last readings, and what follows its latest normal one.
    across = Window.partitionBy(*key).orderBy(SLICE)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    begins = c("first_t")
    if seeded:
        begins = F.when(c("first_r")["seed"] >= 0, c("first_r")["seed"]).otherwise(c("first_t"))
    edges = (
        rows.filter((c("n") == 1) | c("next_t").isNull())
        .groupBy(*part)
        .agg(
            F.min("t").alias("first_t"),
            F.min_by("r", "t").alias("first_r"),
            F.max(F.when(c("n") == 1, c("next_t"))).alias("second_t"),
            F.max_by("r", "t").alias("last_r"),
            *[F.max(f"inner_{i}").alias(f"inner_{i}") for i in numbers],
            *[F.max_by(f"flag_{i}", "t").alias(f"last_flag_{i}") for i in numbers],
        )
        .withColumns(
            {
                "prev_r": F.lag("last_r").over(across),
                "after_t": F.lead("first_t").over(across),
                "begins": F.first(begins).over(across),
            }
        )
        .withColumns({f"head_flag_{i}": judged(i, c("first_r"), c("prev_r")) for i in numbers})
    )

    def follows(i: int) -> Column:
        """The time after the latest normal reading of a slice."""
        inside = F.coalesce(c(f"inner_{i}"), F.when(~c(f"head_flag_{i}"), c("second_t")))
        return F.when(F.coalesce(f"last_flag_{i}", f"head_flag_{i}"), inside).otherwise(c("after_t"))

    edges = edges.withColumns({f"follows_{i}": follows(i) for i in numbers}).select(
        *part,
        "prev_r",
        "after_t",
        "second_t",
        *[c(f"head_flag_{i}") for i in numbers],
        *[F.lead(f"head_flag_{i}").over(across).alias(f"after_flag_{i}") for i in numbers],
        *[F.coalesce(F.max(f"follows_{i}").over(earlier), c("begins")).alias(f"earlier_{i}") for i in numbers],
    )

    # Back to the readings, on the keys they are already partitioned and sorted by.
    out = []
    for i in numbers:
        abnormal = F.coalesce(f"flag_{i}", f"head_flag_{i}")
        second = F.when((c("n") > 1) & ~c(f"head_flag_{i}"), c("second_t"))
        after = F.when(c("next_t").isNull(), c(f"after_flag_{i}")).otherwise(c(f"next_flag_{i}"))
        out += [
            abnormal.alias(f"abnormal_{i}"),
            F.when(abnormal, F.coalesce(c(f"inner_{i}"), second, c(f"earlier_{i}"))).alias(f"start_{i}"),
            (abnormal & ~F.coalesce(after, F.lit(False))).alias(f"is_last_{i}"),
        ]
    return rows.join(edges, part, "left").select(
        *key,
        "t",
        *[c("r")[name].alias(name) for name in read],
        F.coalesce(c("r1")["v"], c("prev_r")["v"]).alias("previous_value"),
        F.coalesce("next_t", "after_t").alias("next_time"),
        *out,
    )


def annotate(
    series: DataFrame,
    rule: Discriminator,
    key: Sequence[str] = ("id",),
    carry: Sequence[str] = ("uri",),
    slice_ms: int = DAY_MS,
    seeded: bool = False,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """``judge`` by one rule. Adds ``previous_value``, ``abnormal``, ``exception_start_time`` (on every row of a run),
    ``is_last``, ``exception_end_time`` (on the last row of a closed run) and ``next_time``."""
    return verdict(judge(series, [rule], key, carry, slice_ms, seeded, cuts), 0)


def verdict(judged: DataFrame, number: int) -> DataFrame:
    """What rule ``number`` says of a series judged by several."""
    kept = [c for c in judged.columns if c.rpartition("_")[0] not in ("abnormal", "start", "is_last")]
    first = [c for c in kept if c != "next_time"]
    last = F.col(f"is_last_{number}")
    return judged.select(
        *first,
        F.col(f"abnormal_{number}").alias("abnormal"),
        F.col(f"start_{number}").alias("exception_start_time"),
        last.alias("is_last"),
        F.when(last, F.col("next_time")).alias("exception_end_time"),
        "next_time",
    )


def all_ranges(judged: DataFrame, rules: Sequence[Discriminator]) -> DataFrame:
    """The ``abnormal_ranges`` of several rules from one pass over the readings."""
    runs = [
        F.when(
            F.col(f"is_last_{i}"),
            F.struct(F.lit(rule.name).alias("abnormal_type"), F.col(f"start_{i}").alias("abnormal_start_time")),
        )
        for i, rule in enumerate(rules)
    ]
    found = judged.filter(reduce(or_, [F.col(f"is_last_{i}") for i in range(len(rules))]))
    found = found.withColumn("run", F.explode(F.filter(F.array(*runs), lambda run: run.isNotNull())))
    return found.select(
        F.col("uri").alias("node_uri"),
        F.col("t").alias("last_abnormal_time"),
        "run.abnormal_type",
        "run.abnormal_start_time",
        F.col("next_time").alias("abnormal_end_time"),
    )


def abnormal_points(annotated: DataFrame, rule: Discriminator) -> DataFrame:
    """One row per abnormal reading, with what it was judged against."""
    return annotated.filter("abnormal").select(
        F.col("uri").alias("node_uri"),
        F.col("t").alias("time"),
        F.col("v").alias("value"),
        F.lit(rule.name).alias("abnormal_type"),
        *[F.col(source).alias(name) for name, source in rule.shows.items()],
    )


def abnormal_ranges(annotated: DataFrame, rule: Discriminator) -> DataFrame:
    """One row per run, named by its last abnormal time; the end of an open run is NULL."""
    return annotated.filter("is_last").select(
        F.col("uri").alias("node_uri"),
        F.col("t").alias("last_abnormal_time"),
        F.lit(rule.name).alias("abnormal_type"),
        F.col("exception_start_time").alias("abnormal_start_time"),
        F.col("exception_end_time").alias("abnormal_end_time"),
    )


def version_changes(judged: DataFrame, old: Discriminator, new: Discriminator, kind: str) -> DataFrame:
    """Change log of the ``points`` or ``ranges`` of two versions of a rule, judged as rules 0 and 1 in one pass."""
    if kind == "ranges":
        there, now = F.col("is_last_0"), F.col("is_last_1")
        key = {"node_uri": F.col("uri"), "last_abnormal_time": F.col("t"), "abnormal_type": F.lit(new.name)}
        states = [{"abnormal_start_time": F.col(f"start_{i}"), "abnormal_end_time": F.col("next_time")} for i in (0, 1)]
    else:
        there, now = F.col("abnormal_0"), F.col("abnormal_1")
        key = {"node_uri": F.col("uri"), "time": F.col("t"), "abnormal_type": F.lit(new.name)}
        states = [
            {"value": F.col("v"), **{shown: F.col(source) for shown, source in rule.shows.items()}} for rule in (old, new)
        ]
    return row_changes(judged, there, now, key, *states)


def sorted_passthrough(readings: DataFrame, order: str = "seq") -> DataFrame:
    """Judges nothing: first arrivals, in time order inside every point."""
    keep = [c for c in readings.columns if c not in ("id", "t", order)]
    unique = first_arrivals(readings, ("id", "t"), order, keep)
    return unique.repartition("id", F.floor(F.col("t") / DAY_MS)).sortWithinPartitions("id", "t")
