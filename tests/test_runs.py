"""Hand cases of the rules and runs, for several slice lengths."""

import random

import pytest

from gaugeline.operators.changes import POINT_KEY, RANGE_KEY, apply_changes, change_log
from gaugeline.operators.discriminators import RULES
from gaugeline.operators.runs import abnormal_points, abnormal_ranges, annotate, sorted_passthrough
from gaugeline.operators.slices import first_arrivals
from helpers import parse, rows, series


def judged(spark, name, text, slice_ms=1000, **rule):
    return annotate(series(spark, parse("p", text), **rule), RULES[name], slice_ms=slice_ms)


def abnormal_times(df):
    return sorted(r.t for r in df.filter("abnormal").collect())


def ranges(df, name):
    out = abnormal_ranges(df, RULES[name])
    return rows(out, "last_abnormal_time", "abnormal_start_time", "abnormal_end_time")


@pytest.mark.parametrize("slice_ms", [1, 2, 3, 1000])
def test_cumulative(spark, slice_ms):
    df = judged(spark, "cumulative", "1:10 2:8 3:7 4:9 5:9 6:1", slice_ms)
    assert abnormal_times(df) == [2, 3, 6]
    assert ranges(df, "cumulative") == [(3, 2, 4), (6, 6, None)]


@pytest.mark.parametrize("name", ["cumulative", "amplitude"])
def test_first_reading_is_normal(spark, name):
    assert abnormal_times(judged(spark, name, "1:5")) == []


def test_limit_on_the_bound(spark):
    assert abnormal_times(judged(spark, "limit", "1:0 2:10 3:10.5")) == [3]


def test_switch_cuts_toward_zero(spark):
    assert abnormal_times(judged(spark, "switch", "1:1.9 2:0.9 3:-0.5")) == [2, 3]


def test_amplitude(spark):
    assert abnormal_times(judged(spark, "amplitude", "1:10 2:15 3:7.5 4:3")) == [4]


@pytest.mark.parametrize("slice_ms", [1, 2, 1000])
def test_amplitude_after_zero(spark, slice_ms):
    assert abnormal_times(judged(spark, "amplitude", "1:0 2:0 3:4", slice_ms)) == [2, 3]


def test_rule_value_not_numeric(spark):
    for name in ("limit", "switch", "amplitude"):
        df = judged(spark, name, "1:500 2:0 3:7", upper="abc", lower="x", amp="y", default="z")
        assert abnormal_times(df) == []


def test_first_arrival_wins(spark):
    df = series(spark, [("p", 1, 5), ("p", 1, 50)])
    assert rows(first_arrivals(df, ("id", "t")), "t", "v") == [(1, 5.0)]
    assert rows(sorted_passthrough(df), "t", "v") == [(1, 5.0)]


def test_run_over_many_slices(spark):
    df = judged(spark, "limit", "1:1 2:20 90:20 91:20 300:20 1000:20 1001:3", slice_ms=10)
    assert ranges(df, "limit") == [(1000, 2, 1001)]
    assert rows(df.filter("abnormal"), "exception_start_time") == [(2,)] * 5


def plain_runs(points, name, upper=10.0, lower=0.0, amp=0.5, default=1):
    """The closed form, written with loops."""
    out = []
    prev, start, last = None, None, None
    for t, v in points:
        flag = {
            "limit": lower > v or v > upper,
            "switch": int(v) != default,
            "cumulative": prev is not None and v < prev,
            "amplitude": prev is not None and (prev == 0 or not -amp <= (v - prev) / prev <= amp),
        }[name]
        if flag:
            start = t if start is None else start
            last = t
        elif start is not None:
            out.append((last, start, t))
            start = None
        prev = v
    if start is not None:
        out.append((last, start, None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", list(RULES))
def test_random_series(spark, name):
    """Slices from one reading to all of them give what loops give."""
    draw = random.Random(7)
    times = sorted(draw.sample(range(400), 120))
    points = [(t, float(draw.choice([0, 1, 2, 5, 20, 30]))) for t in times]
    df = series(spark, [("p", t, v) for t, v in points]).persist()
    for slice_ms in (1, 7, 10_000):
        got = ranges(annotate(df, RULES[name], slice_ms=slice_ms), name)
        assert got == plain_runs(points, name), slice_ms
    df.unpersist()


def test_point_columns(spark):
    df = judged(spark, "cumulative", "1:10 2:8")
    assert rows(abnormal_points(df, RULES["cumulative"]), "node_uri", "time", "value", "previous_value") == [
        ("/u/p", 2, 8.0, 10.0)
    ]
    limits = abnormal_points(judged(spark, "limit", "1:99"), RULES["limit"])
    assert rows(limits, "upper_bound", "lower_bound") == [("10", "0")]


def test_change_log_and_replay(spark):
    old = abnormal_ranges(judged(spark, "limit", "1:20 2:20 4:20 5:1"), RULES["limit"])
    new = abnormal_ranges(judged(spark, "limit", "1:20 2:20 3:5 4:20 5:1"), RULES["limit"])
    log = change_log(old, new, RANGE_KEY)
    assert rows(log, "op", "last_abnormal_time", "abnormal_start_time", "abnormal_end_time") == [
        (1, 2, 1, 3),
        (2, 4, 4, 5),
    ]
    numbered = log.selectExpr("*", "1 AS batch_id").unionByName(log.selectExpr("*", "2 AS batch_id"))
    after = apply_changes(old, numbered, RANGE_KEY)
    assert rows(after, *new.columns) == rows(new, *new.columns)
    back = change_log(new, old, RANGE_KEY).selectExpr("*", "3 AS batch_id")
    assert rows(apply_changes(after, back, RANGE_KEY), *old.columns) == rows(old, *old.columns)


def test_apply_changes_edge_cases(spark):
    base = spark.sql("SELECT 'u' AS node_uri, 1L AS time, 'limit' AS abnormal_type, 5D AS value")
    log = spark.sql(
        "SELECT * FROM VALUES (1, 'u', 1L, 'limit', 9D, 1), (2, 'u', 2L, 'limit', 9D, 1),"
        " (-1, 'u', 3L, 'limit', 9D, 1), (1, 'u', 4L, 'limit', 1D, 1), (-1, 'u', 4L, 'limit', 1D, 2),"
        " (1, 'u', 4L, 'limit', 2D, 3) AS l(op, node_uri, time, abnormal_type, value, batch_id)"
    )
    # Insert leaves a present row; update and delete of absent rows do nothing; delete, then insert.
    assert rows(apply_changes(base, log, POINT_KEY), "time", "value") == [(1, 5.0), (4, 2.0)]
