"""Whole pipelines, from messages to sinks. Rules are read anew in every micro-batch, so a change
of rules needs no restart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gaugeline.operators import aggregates
from gaugeline.sinks import keyed_table
from gaugeline.sinks.dispatch import write_stream
from gaugeline.sources import schemas
from gaugeline.sources.readings import clean, parse_array, rejected, unreadable, with_order
from gaugeline.sources.rules import join_rules, rule_id, split_bound
from gaugeline.streaming.incremental import IncrementalMovingAvg, IncrementalRuns
from gaugeline.streaming.minutes import RunningWindows

Rules = Callable[[SparkSession], DataFrame]
BatchSink = Callable[[DataFrame, int], None]
# Gets the unreadable messages and the readings without a usable value of a batch.
Rejects = Callable[[DataFrame, DataFrame, int], None]


def with_watermark(readings: DataFrame, delay: str) -> DataFrame:
    """Watermark on ``event_time``, which must be a TIMESTAMP; one without zone is cast."""
    timed = readings.withColumn("event_time", F.col("event_time").cast("timestamp"))
    return timed.withWatermark("event_time", delay)


def arrivals(readings: DataFrame) -> DataFrame:
    """Readings with ``seq``, their order of arrival.

    It is the source's (see ``sources.readings.with_order``), the same however a batch is partitioned. Lines of text files have
    none: there it is the order in which this batch happens to be read.
    """
    return readings if "seq" in readings.columns else readings.withColumn("seq", F.monotonically_increasing_id())


def discriminate(
    messages: DataFrame,
    rules: Rules,
    runs: IncrementalRuns,
    checkpoint: str,
    on_unbound: BatchSink | None = None,
    on_reject: Rejects | None = None,
    every: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Messages -> readings -> rules -> abnormal runs; readings without a rule pass through, rejects go to ``on_reject``.

    One query and one read of the source feed all outputs; the joined batch is kept for both parts.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        readings = parse_array(batch)
        if on_reject is not None:
            on_reject(unreadable(batch), rejected(readings), batch_id)
        # Weighed and then broadcast: kept between the two.
        known = rules(batch.sparkSession).persist()
        joined = join_rules(arrivals(clean(readings)), known).persist()
        bound, unbound = split_bound(joined)
        runs(bound, batch_id)
        if on_unbound is not None:
            on_unbound(unbound, batch_id)
        joined.unpersist()
        known.unpersist()

    return write_stream(with_order(messages), "foreach_batch", checkpoint, every=every, drain=drain, write=step)


def moving_average(
    messages: DataFrame,
    rules: Rules,
    averages: IncrementalMovingAvg,
    checkpoint: str,
    on_unbound: BatchSink | None = None,
    on_reject: Rejects | None = None,
    every: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Messages -> readings -> rules -> trailing averages of bound points."""

    def step(batch: DataFrame, batch_id: int) -> None:
        readings = parse_array(batch)
        if on_reject is not None:
            on_reject(unreadable(batch), rejected(readings), batch_id)
        # Weighed and then broadcast: kept between the two.
        known = rules(batch.sparkSession).persist()
        joined = join_rules(arrivals(clean(readings)), known).persist()
        bound, unbound = split_bound(joined)
        averages(bound, batch_id)
        if on_unbound is not None:
            on_unbound(unbound, batch_id)
        joined.unpersist()
        known.unpersist()

    return write_stream(with_order(messages), "foreach_batch", checkpoint, every=every, drain=drain, write=step)


def running_windows(
    messages: DataFrame,
    windows: RunningWindows,
    checkpoint: str,
    layout: T.StructType = schemas.WIRE,
    on_reject: Rejects | None = None,
    every: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Messages -> readings -> running values per point and window; those of silent points are closed in time.

    ``layout`` is ``schemas.WIRE`` for typed values as text or ``schemas.WIRE_CLEANED`` for readings that were cleaned before.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        readings = parse_array(batch, schema=layout)
        if on_reject is not None:
            on_reject(unreadable(batch, schema=T.ArrayType(layout)), rejected(readings), batch_id)
        cleaned = arrivals(clean(readings)).withColumn("id", rule_id(F.col("gateway_id"), F.col("point_id"))).persist()
        windows(cleaned, batch_id)
        cleaned.unpersist()

    return write_stream(with_order(messages), "foreach_batch", checkpoint, every=every, drain=drain, write=step)


def minute_values(
    messages: DataFrame,
    rules: Rules,
    path: str,
    checkpoint: str,
    how: str = "last",
    delay: str = "10 minutes",
    length: str = "1 minute",
    regions: int = 100,
    by_year: bool = False,
    tie: str | None = None,
    every: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Messages -> values per point and window -> keyed table of parts, in update mode.

    Aggregated per point first and bound to rules afterwards: the join then sees window rows rather
    than readings, and its rules may change while the stream runs. Points may share a uri, so the table holds a
    part per point; ``keyed_table.read_parts`` puts them together. ``tie`` names a column that decides between
    readings of one time.
    """
    readings = with_watermark(clean(parse_array(messages)), delay)
    keyed = readings.withColumn("id", rule_id(F.col("gateway_id"), F.col("point_id")))
    keys = ("gateway_id", "point_id")
    values = aggregates.window_parts(keyed, length, keys, how, tie)
    parts = [c for c in values.columns if c not in (*keys, "t")]
    put = keyed_table.put_by_year if by_year else keyed_table.put

    def step(batch: DataFrame, batch_id: int) -> None:
        known = rules(batch.sparkSession).persist()
        bound, _ = split_bound(join_rules(batch, known))
        rows = bound.select("uri", "t", F.col("id").alias("part"), *parts)
        put(keyed_table.with_row_key(rows, regions), path, batch_id)
        known.unpersist()

    return write_stream(
        values, "foreach_batch", checkpoint, "update", every=every, drain=drain, write=step
    )
