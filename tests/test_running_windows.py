"""Running windows, their due times, and the order of the source."""

import random

from pyspark.sql import functions as F

from gaugeline.operators import aggregates
from gaugeline.sources.readings import file_order, open_stream, parse_array, topic_order, with_order
from gaugeline.streaming import jobs
from gaugeline.streaming.minutes import RunningWindows
from helpers import rows

COLUMNS = ("id", "window_start", "sum_v", "n", "last_v", "closed")


def batch(spark, *readings, first=0):
    values = [(i, t, None if v is None else float(v), first + n) for n, (i, t, v) in enumerate(readings)]
    return spark.createDataFrame(values, "id string, t bigint, v double, seq bigint")


def written(spark, path, batch_id):
    return rows(spark.read.parquet(f"{path}/windows/batch_id={batch_id}"), *COLUMNS)


def test_silent_points_are_closed_without_a_reading_of_their_own(spark, tmp_path):
    windows = RunningWindows(str(tmp_path), 10, 10, buckets=16)
    windows(batch(spark, ("silent", 3, 1), ("silent", 1, 5), ("busy", 4, 2)), 0)
    assert written(spark, tmp_path, 0) == [("busy", 0, 2.0, 1, 2.0, False), ("silent", 0, 6.0, 2, 1.0, False)]
    windows(batch(spark, ("busy", 19, 7)), 1)
    assert written(spark, tmp_path, 1) == [("busy", 10, 7.0, 1, 7.0, False)]
    # The watermark reaches 10, the end of the first window.
    for _ in range(2):  # a repeated batch gives the same rows
        windows(batch(spark, ("busy", 20, 8)), 2)
        assert written(spark, tmp_path, 2) == [
            ("busy", 0, 2.0, 1, 2.0, True),
            ("busy", 20, 8.0, 1, 8.0, False),
            ("silent", 0, 6.0, 2, 1.0, True),
        ]
    assert rows(windows.state(spark), "id", "window_start") == [("busy", 10), ("busy", 20)]
    # What comes after the end is late, what comes before it counts.
    windows(batch(spark, ("silent", 9, 1), ("silent", 15, 4), (None, 15, 4), ("x", 15, None)), 3)
    assert rows(spark.read.parquet(f"{tmp_path}/late/batch_id=3"), "id", "t") == [("silent", 9)]
    assert written(spark, tmp_path, 3) == [("silent", 10, 4.0, 1, 4.0, False)]
    assert rows(windows.table(spark).filter("closed"), "id", "window_start") == [("busy", 0), ("silent", 0)]


def test_any_cut_gives_the_same_windows(spark, tmp_path):
    draw = random.Random(7)
    readings = [(f"p{draw.randint(0, 4)}", t + draw.randint(0, 20), draw.randint(0, 9)) for t in range(0, 300, 3)]
    cut = sorted(draw.sample(range(1, len(readings)), 3))
    windows = RunningWindows(str(tmp_path), 40, 25)
    for n, (a, b) in enumerate(zip([0, *cut], [*cut, len(readings)], strict=True)):
        windows(batch(spark, *readings[a:b], first=a), n)
    latest = max(t for _, t, _ in readings)
    expected = []
    for i, start in sorted({(i, t - t % 25) for i, t, _ in readings}):
        own = [(t, n, v) for n, (j, t, v) in enumerate(readings) if j == i and t - t % 25 == start]
        expected.append((i, start, float(sum(v for *_, v in own)), len(own), float(max(own)[2]), start + 25 <= latest - 40))
    assert rows(windows.table(spark), *COLUMNS) == sorted(expected, key=repr)


def test_order_of_the_source_does_not_depend_on_partitions(spark, tmp_path):
    item = F.struct(F.lit("g").alias("gatewayId"), F.lit("a").alias("pointId"), F.lit(5).alias("t"), F.col("id").cast("string").alias("v"))
    messages = spark.range(40).withColumn("value", F.to_json(F.array(item, item)))
    topic = messages.selectExpr("value", "'t' AS topic", "CAST(id % 3 AS INT) AS partition", "id DIV 3 AS offset")
    orders = [rows(parse_array(with_order(topic.repartition(n))), "seq", "v") for n in (1, 7)]
    assert orders[0] == orders[1] and len({seq for seq, _ in orders[0]}) == 80
    assert "arrival" not in with_order(messages.select("value")).columns
    path = str(tmp_path / "in")
    messages.select("value").repartition(4).write.parquet(path)
    files = spark.read.parquet(path).withColumn("arrival", file_order())
    orders = [rows(parse_array(files.repartition(n, "value")), "seq", "v") for n in (2, 5)]
    assert orders[0] == orders[1] and len({seq for seq, _ in orders[0]}) == 80
    # Rows of a file keep their order, and so do readings of a message.
    assert all(a[1] == b[1] for a, b in zip(orders[0][::2], orders[0][1::2], strict=True))
    assert topic_order() is not None


def test_first_arrival_is_the_sources(spark, tmp_path):
    """Two readings of one time in one batch: the row that stands first in the file counts."""
    value = F.concat(F.lit('[{"gatewayId":"g","pointId":"a","t":5,"v":"'), F.col("id").cast("string"), F.lit('"}]'))
    spark.range(50, 0, -1, 1).select(value.alias("value")).write.parquet(str(tmp_path / "in"))
    messages = with_order(open_stream(spark, "parquet", spark.read.parquet(str(tmp_path / "in")).schema, str(tmp_path / "in"), per_trigger=None), file_order())
    windows = RunningWindows(str(tmp_path / "out"), 10, 10)
    jobs.running_windows(messages, windows, str(tmp_path / "cp"), drain=True).awaitTermination()
    # Of equal times the last one to arrive is the window's value.
    assert rows(windows.table(spark), "n", "last_v") == [(50, 1.0)]


def test_sliding_panes_let_go_of_their_state(spark, tmp_path):
    source = tmp_path / "in"
    for n in range(4):
        at = [(p, n * 600_000 + s * 1000, float(s)) for p in "ab" for s in range(0, 300, 7)]
        spark.createDataFrame(at, "point_id string, t bigint, v double").coalesce(1).write.mode("append").parquet(str(source))
    stream = open_stream(spark, "parquet", spark.read.parquet(str(source)).schema, str(source), per_trigger=1)
    timed = jobs.with_watermark(aggregates.with_event_time(stream), "1 minute")
    out = aggregates.sliding_last_panes(timed, ("point_id",), "1 minute", "20 seconds")
    query = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    state = [[s["numRowsTotal"] for s in p["stateOperators"]] for p in query.recentProgress]
    # One row per pane and point at most, and at the end only those of the last minutes.
    assert max(max(s) for s in state if s) <= 2 * 2 * 16
    assert max(state[-1]) <= 2 * 4
    passed = 3 * 600_000 + 294_000 - 60_000
    whole = aggregates.sliding_last(spark.read.parquet(str(source)), ("point_id",), 60_000, 20_000)
    expected = rows(whole.filter(F.col("window_start") + 60_000 <= passed), "point_id", "window_start", "last_v")
    assert rows(spark.read.parquet(str(tmp_path / "out")), "point_id", "window_start", "last_v") == expected
