"""Windows, comparisons, rules, keyed tables."""

import json

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import aggregates, comparisons
from gaugeline.operators.moving import moving_avg
from gaugeline.sinks import keyed_table
from gaugeline.sources import keyed, readings
from gaugeline.sources import rules as rule_source
from helpers import parse, rows, series


def test_moving_average(spark):
    df = moving_avg(series(spark, parse("p", "0:10 60:20 61:30")), 60)
    assert rows(df, "t", "moving_avg") == [(0, 10.0), (60, 15.0), (61, 25.0)]


def test_moving_average_of_nonpositive_sums(spark):
    df = series(spark, parse("p", "0:-5 10:1"))
    assert rows(moving_avg(df, 60), "t", "moving_avg") == [(0, -5.0), (10, -2.0)]
    assert rows(moving_avg(df, 60, clamp_nonpositive=True), "t", "moving_avg") == [(0, 0.0), (10, 0.0)]


@pytest.mark.parametrize("window", [1, 7, 60, 5000])
def test_moving_average_of_any_window(spark, window):
    points = [(t * t % 997, float(t % 13)) for t in range(150)]
    points = sorted(dict(points).items())
    got = rows(moving_avg(series(spark, [("p", t, v) for t, v in points]), window), "t", "moving_avg")
    expected = []
    for t, _ in points:
        inside = [v for u, v in points if t - window <= u <= t]
        expected.append((t, sum(inside) / len(inside)))
    assert [t for t, _ in sorted(got)] == [t for t, _ in expected]
    assert [m for _, m in sorted(got)] == pytest.approx([m for _, m in expected])


@pytest.mark.parametrize("part_ms", [1, 10, 64, 997])
@pytest.mark.parametrize("window", [7, 60, 640, 5000])
def test_moving_average_in_parts(spark, window, part_ms):
    """Blocks cut into parts, also where the part does not divide the window, give what whole blocks give."""
    times = sorted({t * t % 997 - 300 for t in range(150)})
    df = series(spark, [(p, t, float(t % 13)) for p in ("p", "q") for t in times if p == "p" or t % 3])
    whole, cut = (rows(moving_avg(df, window, part_ms=ms), "id", "t", "moving_avg") for ms in (10_000, part_ms))
    assert [r[:2] for r in cut] == [r[:2] for r in whole]
    assert [r[2] for r in cut] == pytest.approx([r[2] for r in whole])


def test_ring_ratio_of_rows_without_key_or_time(spark):
    """They have no successor and are nobody's; equal ones stay apart."""
    df = spark.sql(
        "SELECT * FROM VALUES ('p', 1L, 10D, 'a'), ('p', 2L, 11D, 'b'), ('p', 4L, 5D, 'c'), ('q', 3L, 1D, 'd'),"
        " (NULL, 1L, 7D, 'e'), (NULL, 2L, 8D, 'f'), ('p', NULL, 9D, 'g'), ('p', NULL, 9D, 'g'), ('p', 5L, NULL, 'h')"
        " AS s(id, t, v, note)"
    )
    out = comparisons.ring_ratio(df)
    assert out.columns == ["id", "t", "v", "note", "v2", "ring_ratio", "is_ok"]
    assert rows(out.filter("t IS NOT NULL"), "id", "t", "v", "note", "v2", "ring_ratio") == [("p", 2, 11.0, "b", 10.0, 0.1)]
    assert sorted(r.v2 for r in out.filter("t IS NULL AND v2 IS NOT NULL").collect()) == [1, 5, 7, 8, 9, 9, 11]
    assert out.count() == 9


def test_long_window_of_one_point_is_dealt_to_many_tasks(spark):
    """A month over one point: no task holds a window."""
    month, step = 30 * 86_400_000, 600_000
    df = spark.range(0, 8640).selectExpr("'p' AS id", f"id * {step} AS t", "CAST(id % 7 AS DOUBLE) AS v")
    averaged = moving_avg(df.repartition(1), month)
    got = {r.t: r.moving_avg for r in averaged.collect()}
    values = [n % 7 for n in range(8640)]
    for n in (0, 1, 4319, 4320, 4321, 8639):
        inside = values[max(0, n - month // step) : n + 1]
        assert got[n * step] == pytest.approx(sum(inside) / len(inside))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        dealt = [r.n for r in moving_avg(df, month).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(dealt) == 4 and max(dealt) < 8640 / 2


def test_window_borders(spark):
    df = series(spark, [("p", 1704067259999, 1), ("p", 1704067260000, 2)])
    assert rows(aggregates.window_last(df), "v", "t") == [(1.0, 1704067260000), (2.0, 1704067320000)]


def test_ties_of_any_size(spark):
    df = series(spark, [("p", 5, 1), ("p", 5, 2), ("p", 4, 3)])
    assert rows(aggregates.window_last(df, tie="seq"), "v") == [(2.0,)]
    any_tie = df.withColumn("seq", F.expr("CASE seq WHEN 1 THEN -9223372036854775808 WHEN 2 THEN 9223372036854775807 END"))
    assert rows(aggregates.window_last(any_tie, tie="seq"), "v") == [(2.0,)]
    far = df.withColumn("seq", F.col("seq") + 2**40)
    for length in ("1 minute", "1 day", "365 days"):
        assert rows(aggregates.window_last(far, length, tie="seq"), "v") == [(2.0,)]


def test_sliding_equals_spark_windows(spark):
    points = [("p", t * t % 400_000, t) for t in range(200)] + [("q", 5_000_000, 1)]
    df = aggregates.with_event_time(series(spark, points))
    for window, slide in ((60_000, 1_000), (60_000, 2_000), (60_000, 60_000)):
        ours = aggregates.sliding_last(df, ("id",), window, slide, tie="seq")
        spans = (f"{window // 1000} seconds", f"{slide // 1000} seconds")
        theirs = aggregates.sliding_last_stream(df, ("id",), *spans, tie="seq")
        assert rows(ours, *theirs.columns) == rows(theirs, *theirs.columns)


def test_ring_ratio(spark):
    out = comparisons.ring_ratio(series(spark, parse("p", "1:10 2:10.5 3:20")).select("id", "t", "v"))
    assert rows(out, "t", "v2", "ring_ratio", "is_ok") == [
        (2, 10.0, 0.05, True),
        (3, 10.5, 0.905, False),
        (None, 20.0, None, None),
    ]
    normal, abnormal = comparisons.split_ratio(out)
    assert rows(normal, "t") == [(2,)] and rows(abnormal, "t") == [(3,)]


def test_neighbours(spark):
    df = series(spark, parse("p", "1:10 5:12 900:11")).select("id", "t", "v")
    out = comparisons.previous_reading(df, later=True, slice_ms=2)
    assert rows(out, "t", "previous_t", "previous_v", "next_t", "next_v") == [
        (1, 0, 0.0, 5, 12.0),
        (5, 1, 10.0, 900, 11.0),
        (900, 5, 12.0, 0, 0.0),
    ]
    diffs = comparisons.neighbour_diff(df, slice_ms=2)
    assert rows(diffs, "t", "side", "diff") == [
        (1, "later", 2.0),
        (5, "earlier", 2.0),
        (5, "later", -1.0),
        (900, "earlier", -1.0),
    ]


def messages(spark, *texts):
    return spark.createDataFrame([(x,) for x in texts], "value STRING")


def test_messages(spark):
    good = '{"gatewayId":"gw1","namespace":"ns0","pointId":"%s","t":%d,"s":"good","v":"%s"}'
    df = messages(
        spark,
        "[" + good % ("a", 1, "F#12.5") + "," + good % ("b", 2, "S#down") + "]",
        "[{",
        '[{"gatewayId":"gw1","pointId":"c","t":3}]',
    )
    parsed = readings.parse_array(df)
    assert rows(readings.clean(parsed), "point_id", "t", "v") == [("a", 1, 12.5)]
    assert rows(readings.rejected(parsed), "point_id") == [("c",)]
    assert rows(readings.unreadable(df), "value") == [("[{",)]


def rule_document(params, *points):
    entry = {"instanceParams": json.dumps(params), "points": [{"id": i, "uri": u} for i, u in points]}
    return json.dumps({"data": [entry]})


def test_rules(spark):
    docs = spark.createDataFrame(
        [
            (1, rule_document([{"value": "100"}, {"value": "0"}], ("/gw1/a", "/u/a"), ("/gw1/b", "/u/b"))),
            (2, rule_document([{"value": "7"}, {"value": "1"}], ("/gw1/b", "/u/b2"))),
            (3, "no json"),
        ],
        "n INT, value STRING",
    )
    options = {"job.rule.upperbound": "$.0.value", "job.rule.lowerbound": "$.1.value", "x": "y"}
    params = rule_source.params_from_options(options, "job.rule.")
    rules = rule_source.parse_rules(docs, params, order="n")
    assert rows(rules, "id", "uri", "upperbound", "lowerbound") == [
        ("/gw1/a", "/u/a", "100", "0"),
        ("/gw1/b", "/u/b2", "7", "1"),
    ]
    assert rows(rule_source.unreadable_rules(docs), "n") == [(3,)]


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_join_rules_broadcast_or_spread(spark, monkeypatch, limit):
    facts = spark.createDataFrame(
        [(n, "gw1", "hot" if n % 3 else f"p{n}", 1.0) for n in range(60)], "seq INT, gateway_id STRING, point_id STRING, v DOUBLE"
    )
    rules = spark.createDataFrame([("/gw1/hot", "/u/hot"), ("/gw1/p3", "/u/p3")], "id STRING, uri STRING")
    monkeypatch.setattr(rule_source, "fits_broadcast", lambda df: limit > 0)
    joined = rule_source.join_rules(facts, rules)
    bound, unbound = rule_source.split_bound(joined)
    assert bound.count() == 41 and unbound.count() == 19
    assert sorted(joined.columns) == ["gateway_id", "id", "point_id", "seq", "uri", "v"]


def test_size_check(spark):
    small = spark.range(10).withColumn("x", F.lit("abc"))
    assert rule_source.fits_broadcast(small)
    assert not rule_source.fits_broadcast(small, rows=9)
    assert not rule_source.fits_broadcast(small, size=100)


def test_keyed_table(spark, tmp_path):
    path = str(tmp_path / "table")
    minute = 1704067260000
    first = spark.createDataFrame([("/gw/p1", 1.0, minute), ("/gw/p2", 2.0, minute)], "uri STRING, v DOUBLE, t LONG")
    again = spark.createDataFrame([("/gw/p1", 5.0, minute), ("/gw/p1", 6.0, minute + 60000)], "uri STRING, v DOUBLE, t LONG")
    keyed_table.put(keyed_table.with_row_key(first), path, 0)
    keyed_table.put(keyed_table.with_row_key(again), path, 1)
    keyed_table.put(keyed_table.with_row_key(again), path, 1)
    table = keyed_table.read(spark, path)
    everything = [("/gw/p1", 5.0, minute), ("/gw/p1", 6.0, minute + 60000), ("/gw/p2", 2.0, minute)]
    assert rows(table, "uri", "v", "t") == everything
    got = keyed.get(table, "77/gw/p1170406726")
    assert rows(got, "v") == [(5.0,)]
    plan = got._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(salt" in plan and "PushedFilters: [IsNotNull(row_key)" in plan
    assert rows(keyed.scan(table, "77/gw/p1170406726", "77/gw/p1170406732", columns=["v"]), "v") == [(5.0,)]
    keyed_table.compact(spark, path, str(tmp_path / "compact"))
    compacted = keyed_table.read(spark, str(tmp_path / "compact"))
    assert rows(compacted, "uri", "v", "t") == everything
    gone = table.filter("uri = '/gw/p2'")
    assert keyed_table.delete_keys(table, gone).count() == 2
    assert keyed_table.clear_column(table, gone, "v").filter("v IS NULL").count() == 1
    assert keyed_table.truncated(table).count() == 0
    assert "v" not in keyed_table.drop_family(table, ["v"]).columns


def test_versions(spark):
    cells = spark.createDataFrame([("a", t, t * 10) for t in range(200)] + [("b", 5, 1)], "k STRING, ts LONG, v LONG")
    assert rows(keyed.versions(cells, ["k"]), "k", "ts") == [("a", 199), ("b", 5)]
    newest = keyed.versions(cells, ["k"], max_versions=3, min_stamp=5, max_stamp=100)
    assert rows(newest, "k", "ts") == [("a", 97), ("a", 98), ("a", 99), ("b", 5)]


def test_versions_of_a_rule_in_one_pass_equal_the_join_of_tables(spark):
    from gaugeline.operators.changes import POINT_KEY, RANGE_KEY, change_log
    from gaugeline.operators.discriminators import RULES, renamed
    from gaugeline.operators.runs import abnormal_points, abnormal_ranges, judge, verdict, version_changes

    values = [5, 11, 12, 3, 30, 31, 4, 12, 12, 40, 1, 11]
    first = series(spark, [("p", 10 * n, v) for n, v in enumerate(values)] + [("q", n, v) for n, v in enumerate(values[::-1])])
    both = first.selectExpr("*", "'20' AS up2", "'4' AS low2")
    old = RULES["limit"]
    new = renamed(old, {"upperbound": "up2", "lowerbound": "low2"})
    judged = judge(both, (old, new), slice_ms=30)
    for kind, form, key in (("points", abnormal_points, POINT_KEY), ("ranges", abnormal_ranges, RANGE_KEY)):
        expected = change_log(form(verdict(judged, 0), old), form(verdict(judged, 1), new), key)
        got = version_changes(judged, old, new, kind)
        assert sorted(got.columns) == sorted(expected.columns)
        assert rows(got, *expected.columns) == rows(expected, *expected.columns)
        assert {r.op for r in got.collect()} == {1, 2, -1} or kind == "points"
