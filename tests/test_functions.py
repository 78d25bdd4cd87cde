"""Scalar hand cases."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal, getcontext
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.functions import decimals, json_fields, keys, times, values


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def column(spark, items, kind, build):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i INT, x {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("x"))).collect()]


def test_decode(spark):
    raw = ["B#true", "B#false", "B#x", "F#1.5", "2.5", "S#down", "junk", None]
    got = column(spark, raw, "STRING", values.decode_value)
    assert got == [1.0, 0.0, 0.0, 1.5, 2.5, None, None, None]
    assert column(spark, ["F#12"], "STRING", lambda x: values.strip_prefix(x, 2)) == ["12"]
    assert column(spark, ["B#true"], "STRING", values.value_type) == ["B"]


def test_limits_on_the_bound(spark):
    low, high = F.lit("0"), F.lit("10")
    v = [0.0, 10.0, 10.5, 5.0]
    assert column(spark, v, "DOUBLE", lambda x: values.limit_ok(x, low, high)) == [False, False, False, True]
    assert column(spark, v, "DOUBLE", lambda x: values.limit_outside(x, low, high)) == [False, False, True, False]
    assert column(spark, [1.9, 0.9, -0.5], "DOUBLE", lambda x: values.switch_ok(x, F.lit("1"))) == [True, False, False]


def test_row_keys(spark):
    uri, t = F.lit("/gw/p1"), F.lit(1704067260000)
    key = keys.row_key(uri, t, keys.salt(uri, 100))
    got = one(spark, keys.java_hash(uri), keys.salt(uri, 100), key, keys.row_key_time(key), keys.row_key_md5(uri, t))
    assert got[:4] == (1444286577, 77, "77/gw/p1170406726", 1704067260000)
    assert got[4].endswith("1704067260000") and len(got[4]) == 45
    assert one(spark, keys.row_key_time(F.lit("no digits")))[0] == 0
    with pytest.raises(ValueError):
        keys.salt(uri, 101)


def jvm_hash(text):
    h = 0
    data = text.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (h * 31 + int.from_bytes(data[i : i + 2])) % 2**32
    return h - 2**32 if h >= 2**31 else h


def test_hash_of_any_text(spark):
    texts = ["", "a", "/plant/gw1/click", "温度/传感器", "héllo", "😀 smile", "x" * 200]
    assert column(spark, texts, "STRING", keys.java_hash) == [jvm_hash(x) for x in texts]
    assert column(spark, [None], "STRING", keys.java_hash) == [None]


def test_durations(spark):
    texts = ["10ms", "2m", "1n", "0s", "x", "3H", "5", "1w2", ""]
    got = column(spark, texts, "STRING", times.duration_millis)
    assert got == [10, 120000, 2592000000, None, None, 10800000, None, None, None]


def test_times(spark):
    now = F.lit(1_700_000_000_000)
    cases = {
        "123ms": 123,
        "NOW": 1_700_000_000_000,
        "5m-ago": 1_699_999_700_000,
        "x-ago": None,
        "2024/01/02": 1704153600000,
        "2024/01/02 03:04": 1704164640000,
        "2024/01/02-03:04:05": 1704164645000,
        "2024-01-02": 1704153600000,
        "2024-01-02 03:04:05": 1704164645000,
        "2024/13/02": None,
        "1355961600": 1355961600000,
        "1355961600000": 1355961600000,
        "1355961600.5": 13559616005,
        "1355961600.123": 1355961600123,
        "13559616.1": None,
        "-5": None,
        "": -1,
    }
    got = column(spark, list(cases), "STRING", lambda x: times.time_millis(x, now=now))
    assert dict(zip(cases, got, strict=True)) == cases
    shanghai = column(spark, ["2024-01-02"], "STRING", lambda x: times.time_millis(x, "Asia/Shanghai"))
    assert shanghai == [1704153600000 - 8 * 3600000]


def test_interval_in_a_zone(spark):
    zone = ZoneInfo("America/New_York")
    moment = dt.datetime(2024, 3, 15, 13, 47, 12, tzinfo=zone)
    t = F.lit(int(moment.timestamp() * 1000))

    def local(*at):
        return int(dt.datetime(*at, tzinfo=zone).timestamp() * 1000)

    expected = {
        (15, "m"): local(2024, 3, 15, 13, 45),
        (6, "h"): local(2024, 3, 15, 12),
        (1, "d"): local(2024, 3, 15),
        (10, "d"): local(2024, 3, 11),
        (1, "w"): local(2024, 3, 10),
        (1, "n"): local(2024, 3, 1),
        (2, "n"): local(2024, 3, 1),
        (5, "n"): local(2024, 1, 1),
        (1, "y"): local(2024, 1, 1),
    }
    got = one(spark, *[times.interval_start(t, n, u, "America/New_York") for n, u in expected])
    assert dict(zip(expected, got, strict=True)) == expected
    with pytest.raises(ValueError):
        times.interval_start(t, 0, "m")


def test_hours(spark):
    t = F.lit(1704070800000 + 15 * 60000)
    got = one(
        spark, times.hour_floor(t), times.hour_ceiling(t), times.hour_offset(t), times.from_hour(times.hour_floor(t), times.hour_offset(t))
    )
    assert got == (17040708, 17040744, 900000, 1704071700000)
    top = F.lit(1704070800000)
    assert one(spark, times.hour_ceiling(top), times.hour_floor(F.lit(-1)), times.hour_ceiling(F.lit(-1))) == (17040708, -1, -1)


def test_division(spark):
    getcontext().prec = 80
    draw = random.Random(3)
    pairs = [
        (
            draw.choice([draw.randint(-(10**7), 10**7) / 100, draw.randint(1, 10**6) / 10**6]),
            float(draw.choice([2, 4, 8, 16, 64, 128, 1024, 3, 7, 2**20, draw.randint(1, 10**5) / 100])),
        )
        for _ in range(500)
    ]
    df = spark.createDataFrame(pairs, "a DOUBLE, b DOUBLE")
    for digits in (0, 2, 5, 6, 10):
        for row in df.select("a", "b", decimals.divide(F.col("a"), F.col("b"), digits).alias("q")).collect():
            exact = (Decimal(repr(row.a)) / Decimal(repr(row.b))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)
            assert row.q == float(exact), (row, digits)
    assert one(spark, decimals.divide(F.lit(1.0), F.lit(0.0))) == (None,)


def test_decimal_sum(spark):
    a, b = F.lit(0.1), F.lit(0.2)
    assert one(spark, decimals.add(a, b), decimals.subtract(a, b), decimals.multiply(a, b)) == (0.3, -0.1, 0.02)


def test_json_fields(spark):
    doc = F.lit('{"n": 3.7, "b": true, "s": "x", "d": 1704067200000, "zero": 0}')
    got = one(
        spark,
        json_fields.int_field(doc, "n", 0),
        json_fields.int_field(doc, "s", 9),
        json_fields.bool_field(doc, "b", False),
        json_fields.bool_field(doc, "zero", True),
        json_fields.bool_field(doc, "gone", True),
        json_fields.text_field(doc, "s", "none"),
        json_fields.text_field(doc, "gone", "none"),
        F.unix_millis(json_fields.date_field(doc, "d")),
        json_fields.date_field(doc, "gone"),
    )
    assert got == (3, 9, True, False, True, "x", "none", 1704067200000, None)


def test_drop_fields(spark):
    doc = F.lit('{"a":1,"b":{"c":2,"d":{"e":3,"f":4}},"g":"x"}')
    got = one(
        spark,
        json_fields.drop_fields(doc, ["a", "b.d.e"]),
        json_fields.drop_fields(doc, ["b.d", "zz", "g"]),
        json_fields.drop_top_fields(doc, ["b", "zz"]),
    )
    assert got == ('{"b":{"c":2,"d":{"f":4}},"g":"x"}', '{"a":1,"b":{"c":2}}', '{"a":1,"g":"x"}')
