"""Inputs the test tables don't hold: any sequence of changes, any double, unknown JSON fields, NaN, shared uris, silent points."""

from __future__ import annotations

import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from gaugeline import session
from gaugeline.functions import decimals, json_fields, values
from gaugeline.operators.changes import DELETE, INSERT, UPDATE, apply_changes
from gaugeline.operators.discriminators import RULES
from gaugeline.plans.queries import QUERIES
from gaugeline.streaming.incremental import IncrementalRuns


def fold(base, log):
    """The changes one by one."""
    table = dict(base)
    for op, key, value, *_ in log:
        if op == INSERT:
            table.setdefault(key, value)
        elif op == UPDATE and key in table:
            table[key] = value
        elif op == DELETE:
            table.pop(key, None)
    return sorted(table.items())


def test_changes_of_any_sequence(spark):
    rng = random.Random(4)
    base = [(k, 100 + k) for k in range(0, 400, 2)]
    log = []
    for k in range(400):
        for n in range(rng.randrange(7)):
            log.append((rng.choice((INSERT, UPDATE, DELETE)), k, n, n // 3, n))
    table = spark.createDataFrame(base, "k int, v int")
    changes = spark.createDataFrame(log, "op int, k int, v int, batch_id int, seq int")
    got = apply_changes(table, changes, ["k"])
    assert sorted((r.k, r.v) for r in got.collect()) == fold(base, log)
    again = apply_changes(table, changes.union(changes), ["k"])
    assert sorted((r.k, r.v) for r in again.collect()) == fold(base, log)


@pytest.mark.parametrize(
    ("present", "log", "want"),
    [
        (5, [DELETE, UPDATE], None),
        (5, [UPDATE, INSERT], 0),
        (None, [INSERT, INSERT], 0),
        (None, [INSERT, DELETE, UPDATE], None),
    ],
)
def test_changes_named(spark, present, log, want):
    base = spark.createDataFrame([(1, present)] if present else [], "k int, v int")
    changes = spark.createDataFrame([(op, 1, n, n) for n, op in enumerate(log)], "op int, k int, v int, batch_id int")
    assert [r.v for r in apply_changes(base, changes, ["k"]).collect()] == ([] if want is None else [want])


def test_decimals_are_the_texts(spark):
    rng = random.Random(1)
    odd = [0.0, 0.1, 0.2, 1e-7, 0.1234567, 1e12, 1.0, -1e-4, 1e-4, 7.0, 1e300, -1e-300, 12345678901234567.0, 2.2250738585072014e-308, 0.5, 2.5]
    pairs = [(a, b) for a in odd for b in odd]
    pairs += [(rng.uniform(-1, 1) * 10 ** rng.randrange(-12, 13), rng.uniform(-1, 1) * 10 ** rng.randrange(-12, 13)) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a double, b double")
    a, b = F.col("a"), F.col("b")
    got = df.select("a", "b", decimals.add(a, b), decimals.subtract(a, b), decimals.multiply(a, b), decimals.divide(a, b)).collect()
    from decimal import localcontext

    with localcontext() as context:
        context.prec = 800
        for x, y, added, less, product, quotient in got:
            p, q = Decimal(repr(x)), Decimal(repr(y))
            assert (added, less, product) == (float(p + q), float(p - q), float(p * q)), (x, y)
            if y == 0:
                assert quotient is None
                continue
            exact = p / q
            want = float(exact.quantize(Decimal(1).scaleb(-10), ROUND_HALF_UP)) if abs(exact) < Decimal(10) ** 700 else math.inf
            assert quotient == want or math.isclose(quotient, want, rel_tol=3e-16), (x, y, quotient, want)


def test_unknown_json_fields_stay(spark):
    doc = F.lit('{"id":1,"extra":2,"n":null,"inner":{"a":1,"b":2,"c":3},"list":[{"b":1}],"text":"x"}')
    got = spark.range(1).select(json_fields.drop_fields(doc, ["inner.b", "text", "list.b", "n.x"])).first()[0]
    assert got == '{"id":1,"extra":2,"n":null,"inner":{"a":1,"c":3},"list":[{"b":1}]}'


def test_numbers_that_are_none(spark):
    nan, v = F.lit(math.nan), F.lit(1.0)
    ten, zero = F.lit("10"), F.lit("0")
    row = spark.range(1).select(
        values.limit_outside(nan, zero, ten),
        values.limit_ok(nan, zero, ten),
        values.limit_outside(v, F.lit("NaN"), ten),
        values.switch_ok(F.lit(3e9), F.lit("2147483647")),
        values.switch_ok(nan, F.lit("0")),
        values.switch_ok(F.lit(None).cast("double"), F.lit("0")),
        RULES["cumulative"].abnormal(F.struct(v.alias("v")), F.struct(nan.alias("v"))),
    )
    assert tuple(row.first()) == (False, False, False, True, True, None, False)


def test_points_of_one_uri_meet(spark, tmp_path):
    from gaugeline.sinks import keyed_table
    from gaugeline.sources.readings import open_stream
    from gaugeline.streaming import jobs
    from test_streams import drop_message, rules_from, write_rules

    inbox, rules = tmp_path / "in", tmp_path / "rules"
    write_rules(rules, ("/g/a", "/u/same", "10", "0"), ("/g/b", "/u/same", "10", "0"))
    base = 1704067200000
    drop_message(inbox, 1, ("a", base, 1), ("a", base + 1, 3), ("b", base + 2, 20))
    for how, want in (("avg", 8.0), ("last", 20.0)):
        messages = open_stream(spark, "text", path=str(inbox), per_trigger=None)
        path = str(tmp_path / how)
        jobs.minute_values(messages, rules_from(rules), path, str(tmp_path / f"cp-{how}"), how=how, drain=True).awaitTermination()
        assert [(r.uri, r.v) for r in keyed_table.read_parts(spark, path, how).collect()] == [("/u/same", want)]


def test_rejects_of_a_stream(spark, tmp_path):
    from gaugeline.sources.readings import open_stream
    from gaugeline.streaming import jobs
    from test_streams import drop_message, rules_from, write_rules

    inbox, rules, seen = tmp_path / "in", tmp_path / "rules", []
    write_rules(rules, ("/g/a", "/u/a", "10", "0"))
    drop_message(inbox, 1, ("a", 1000, 5))
    (inbox / "2.txt").write_text('[{"gatewayId":"g",\n[{"gatewayId":"g","pointId":"a","t":5,"v":"F#x"}]\n')
    runs = IncrementalRuns(RULES["limit"], str(tmp_path / "out"), 1000)
    messages = open_stream(spark, "text", path=str(inbox), per_trigger=None)
    jobs.discriminate(
        messages, rules_from(rules), runs, str(tmp_path / "cp"), drain=True,
        on_reject=lambda unread, bad, batch_id: seen.append((unread.count(), bad.count())),
    ).awaitTermination()
    assert seen == [(1, 1)]


def _batch(spark, rows):
    return spark.createDataFrame([(i, t, v, "10", "0", "u" + i, n) for n, (i, t, v) in enumerate(rows)],
                                 "id string, t bigint, v double, upperbound string, lowerbound string, uri string, seq bigint")


def test_silent_points_leave_an_anchor_and_nothing_stays_cached(spark, tmp_path):
    runs = IncrementalRuns(RULES["limit"], str(tmp_path / "runs"), 100)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    runs(_batch(spark, [("silent", t, 20.0 if t > 30 else 5.0) for t in range(50)]), 0)
    for n in range(1, 4):
        runs(_batch(spark, [("busy", 100_000 * n, 5.0)]), n)
    assert [r.t for r in runs.state(spark).filter("id = 'silent'").collect()] == [49]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    # The anchor still knows its run: a normal reading ends it.
    runs(_batch(spark, [("silent", 400_000, 5.0)]), 4)
    got = [(r.abnormal_start_time, r.abnormal_end_time) for r in runs.table(spark, "ranges").collect()]
    assert got == [(31, 400_000)]


def test_folder_of_another_run_is_refused(spark, tmp_path):
    runs = IncrementalRuns(RULES["limit"], str(tmp_path / "runs"), 100)
    runs(_batch(spark, [("a", 1, 5.0)]), 0)
    runs(_batch(spark, [("a", 1, 5.0)]), 0)  # a repeated batch is no other run
    runs(_batch(spark, [("a", 2, 5.0)]), 1)
    with pytest.raises(RuntimeError, match="another run"):
        IncrementalRuns(RULES["limit"], str(tmp_path / "runs"), 100)(_batch(spark, [("b", 1, 5.0)]), 0)


def test_more_files_than_a_batch_takes(spark, tmp_path, monkeypatch):
    source = "/root/testdata/sf0.001"
    spark.read.parquet(f"{source}/events.parquet").repartition(30).write.parquet(str(tmp_path / "events.parquet" / "x"))
    (tmp_path / "events.parquet" / "x").rename(tmp_path / "many")
    (tmp_path / "events.parquet").rmdir()
    (tmp_path / "many").rename(tmp_path / "events.parquet")
    monkeypatch.setattr("gaugeline.plans.queries.FILES_PER_BATCH", 8)
    got = QUERIES["stream_sliding_last"](spark, str(tmp_path)).collect()
    monkeypatch.undo()
    want = QUERIES["stream_sliding_last"](spark, source).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_shared_folder_has_a_shared_place():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        def __init__(self, conf, own, master="spark://m:7077"):
            self.conf = Conf(conf)
            self.sparkContext = type("Context", (), {"getCheckpointDir": staticmethod(lambda: own), "master": master})

    place = {"spark.checkpoint.dir": "hdfs:/a", "spark.sql.warehouse.dir": "hdfs:/w"}
    assert session.shared_folder(Session(place, "hdfs:/b"), "n").startswith("hdfs:/a/n-")
    del place["spark.checkpoint.dir"]
    assert session.shared_folder(Session(place, "hdfs:/b"), "n").startswith("hdfs:/b/n-")
    assert session.shared_folder(Session(place, None), "n").startswith("hdfs:/w/n-")
    with pytest.raises(RuntimeError):
        session.shared_folder(Session({}, None), "n")
    # The warehouse of a session that set none is a folder of the driver's machine.
    unset = {"spark.sql.warehouse.dir": "file:/home/me/spark-warehouse"}
    with pytest.raises(RuntimeError):
        session.shared_folder(Session(unset, None), "n")
    assert session.shared_folder(Session(unset, None, "local[8]"), "n").startswith("file:/home/me/spark-warehouse/n-")
    assert session.shared_folder(Session(unset, "/shared"), "n").startswith("/shared/n-")
