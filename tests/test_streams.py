"""Pipelines over file streams: parsing, rules, restart, sinks."""

import json

from pyspark.sql import functions as F

from gaugeline.operators.changes import RANGE_KEY
from gaugeline.operators.discriminators import RULES
from gaugeline.sinks import jdbc, keyed_table
from gaugeline.sinks.dispatch import write_stream
from gaugeline.sinks.keyed_json import SHORT_FIELDS, keyed_json, write_topic
from gaugeline.sinks.once import once_per_batch
from gaugeline.sinks.rows import RowWriter
from gaugeline.sources.readings import open_stream
from gaugeline.streaming import jobs
from gaugeline.streaming.incremental import IncrementalMovingAvg, IncrementalRuns
from helpers import rows

RANGE = ("node_uri", "last_abnormal_time", "abnormal_start_time", "abnormal_end_time")


def drop_message(folder, n, *readings):
    folder.mkdir(exist_ok=True)
    items = [
        {"gatewayId": "g", "namespace": "n", "pointId": p, "t": t, "s": "good", "v": f"F#{v}"} for p, t, v in readings
    ]
    (folder / f"{n}.txt").write_text(json.dumps(items) + "\n")


def rules_from(path):
    def rules(spark):
        return spark.read.schema("id STRING, uri STRING, upperbound STRING, lowerbound STRING").json(str(path))

    return rules


def write_rules(path, *entries):
    path.mkdir(exist_ok=True)
    lines = [json.dumps({"id": i, "uri": u, "upperbound": hi, "lowerbound": lo}) for i, u, hi, lo in entries]
    (path / "rules.json").write_text("\n".join(lines))


def test_discriminate_restart_and_rule_refresh(spark, tmp_path):
    inbox, rules, root = tmp_path / "in", tmp_path / "rules", str(tmp_path / "out")
    write_rules(rules, ("/g/a", "/u/a", "10", "0"))
    normal, unbound = str(tmp_path / "normal"), str(tmp_path / "unbound")

    def topic(path):
        return lambda df, n: write_topic(keyed_json(df), "parquet", path)

    def run():
        runs = IncrementalRuns(
            RULES["limit"],
            root,
            10_000,
            carry=("uri", "gateway_id", "namespace", "point_id", "s"),
            on_normal=topic(normal),
        )
        messages = open_stream(spark, "text", path=str(inbox), per_trigger=1)
        jobs.discriminate(
            messages, rules_from(rules), runs, str(tmp_path / "cp"), topic(unbound), drain=True
        ).awaitTermination()
        return runs

    drop_message(inbox, 1, ("a", 1000, 20), ("a", 2000, 20), ("b", 1000, 99))
    first = run()
    assert rows(first.table(spark, "ranges"), *RANGE) == [("/u/a", 2000, 1000, None)]
    # A new process goes on from the checkpoint; b has a rule by now.
    write_rules(rules, ("/g/a", "/u/a", "10", "0"), ("/g/b", "/u/b", "50", "0"))
    drop_message(inbox, 2, ("a", 1500, 5), ("a", 3000, 1), ("b", 2000, 99))
    second = run()
    assert rows(second.table(spark, "ranges"), *RANGE) == [
        ("/u/a", 1000, 1000, 1500),
        ("/u/a", 2000, 2000, 3000),
        ("/u/b", 2000, 2000, None),
    ]
    sent = [json.loads(r.value) for r in spark.read.parquet(normal).collect()]
    assert sorted((m["pointId"], m["t"], m["v"]) for m in sent) == [("a", 1500, 5.0), ("a", 3000, 1.0)]
    assert [r.key for r in spark.read.parquet(unbound).collect()] == ["b"]


def test_moving_average_stream(spark, tmp_path):
    inbox, rules = tmp_path / "in", tmp_path / "rules"
    write_rules(rules, ("/g/a", "/u/a", "10", "0"))
    drop_message(inbox, 1, ("a", 0, 10), ("a", 60, 20), ("a", 61, 30), ("b", 5, 1))
    averages = IncrementalMovingAvg(str(tmp_path / "out"), 1000)
    messages = open_stream(spark, "text", path=str(inbox), per_trigger=None)
    jobs.moving_average(
        messages, rules_from(rules), averages, str(tmp_path / "cp"), drain=True
    ).awaitTermination()
    assert rows(averages.table(spark), "t", "moving_avg") == [(0, 10.0), (60, 15.0), (61, 25.0)]


def test_minute_values_over_batches(spark, tmp_path):
    inbox, rules, path = tmp_path / "in", tmp_path / "rules", str(tmp_path / "table")
    write_rules(rules, ("/g/a", "/u/a", "10", "0"))
    base = 1704067200000
    for how, expected in (("avg", 2.0), ("last", 3.0), ("last_ingest", 3.0)):
        drop_message(inbox, f"{how}1", ("a", base, 1), ("a", base + 60_000, 9), ("b", base, 7))
        run = dict(how=how, drain=True, by_year=how == "last_ingest")

        def go(run=run, how=how):
            messages = open_stream(spark, "text", path=str(inbox / f"{how}*.txt"), per_trigger=None)
            jobs.minute_values(
                messages, rules_from(rules), f"{path}/{how}", str(tmp_path / f"cp-{how}"), **run
            ).awaitTermination()

        go()
        drop_message(inbox, f"{how}2", ("a", base + 30_000, 3))
        go()  # the minute goes on after a restart
        table = keyed_table.read_parts(spark, f"{path}/{how}", how)
        assert rows(table, "uri", "v", "t") == [("/u/a", expected, base + 60_000), ("/u/a", 9.0, base + 120_000)]


def test_watermark_drops_late_windows(spark, tmp_path):
    inbox, rules, path = tmp_path / "in", tmp_path / "rules", str(tmp_path / "table")
    write_rules(rules, ("/g/a", "/u/a", "10", "0"))
    base = 1704067200000

    def go():
        messages = open_stream(spark, "text", path=str(inbox), per_trigger=None)
        jobs.minute_values(
            messages, rules_from(rules), path, str(tmp_path / "cp"), delay="1 minute", drain=True
        ).awaitTermination()

    drop_message(inbox, 1, ("a", base, 1), ("a", base + 600_000, 2))
    go()
    drop_message(inbox, 2, ("a", base + 30_000, 3))
    go()
    assert rows(keyed_table.read_parts(spark, path, "last"), "v", "t") == [(1.0, base + 60_000), (2.0, base + 660_000)]


def test_once_per_batch(spark, tmp_path):
    written = []
    ledger = str(tmp_path / "ledger")
    df = spark.range(1)
    for batch in (0, 0, 1):
        once_per_batch(lambda d, n: written.append(n), ledger)(df, batch)
    assert written == [0, 1]


def test_the_ledger_stays_small(spark, tmp_path):
    written = []
    ledger = tmp_path / "ledger"
    # An entry of a ledger that grew with its batches counts as well.
    spark.range(1).selectExpr("3L AS batch_id").write.parquet(str(ledger))
    for batch in (2, 3, 4, 5, 5, 6, 7, 7, 8):
        once_per_batch(lambda d, n: written.append(n), str(ledger))(spark.range(1), batch)
    assert written == [4, 5, 6, 7, 8]
    assert sorted(p.name for p in ledger.iterdir() if p.is_dir()) == ["slot-0", "slot-1"]
    # A failure while a slot was replaced: the other one names the batch before, which is not repeated.
    for file in (ledger / "slot-0").iterdir():
        file.unlink()
    for batch in (7, 8):
        once_per_batch(lambda d, n: written.append(n), str(ledger))(spark.range(1), batch)
    assert written == [4, 5, 6, 7, 8, 8]


def test_dispatch(spark, tmp_path):
    inbox = tmp_path / "in"
    drop_message(inbox, 1, ("a", 1704067200000, 1))
    rows_of = spark.readStream.schema("x STRING").text(str(inbox)).selectExpr(
        "'/u/a' AS uri", "1D AS v", "1704067260000L AS t", "'g' AS gateway_id", "'n' AS namespace", "'a' AS point_id", "'s' AS s"
    )
    keyed_path = str(tmp_path / "keyed")
    for kind in ("hbase", "keyed_year"):
        write_stream(
            rows_of, kind, str(tmp_path / f"cp-{kind}"), drain=True, path=f"{keyed_path}/{kind}"
        ).awaitTermination()
        assert rows(keyed_table.read(spark, f"{keyed_path}/{kind}"), "v", "year") == [(1.0, 2024)]
    write_stream(rows_of, "console", str(tmp_path / "cp-c"), drain=True, numRows=1).awaitTermination()

    class Client:
        def close(self):
            pass

    store = tmp_path / "foreach"
    store.mkdir()

    def put(client, group):
        name = "-".join(r["uri"].replace("/", "_") for r in group)
        (store / name).write_text(str(len(group)))

    write_stream(
        rows_of, "foreach", str(tmp_path / "cp-f"), drain=True, writer=RowWriter(Client, put)
    ).awaitTermination()
    assert [f.name for f in store.iterdir()] == ["_u_a"]


def test_jdbc_dispatch_appends_the_layout(spark, tmp_path, monkeypatch):
    """No database is started here: what reaches the writer is checked instead."""
    inbox = tmp_path / "in"
    drop_message(inbox, 1, ("a", 1, 1))
    calls = []
    monkeypatch.setattr(
        jdbc, "append", lambda df, url, table, **options: calls.append((df.columns, url, table, options, df.count()))
    )
    stream = spark.readStream.schema("x STRING").text(str(inbox)).selectExpr("'u' AS uri", "1D AS v", "2L AS t")
    write_stream(
        stream,
        "mysql",
        str(tmp_path / "cp"),
        drain=True,
        url="jdbc:x",
        table="target",
        columns={"node_uri": "uri", "value": "v"},
        user="me",
        ledger=str(tmp_path / "ledger"),
    ).awaitTermination()
    assert calls == [(["node_uri", "value"], "jdbc:x", "target", {"user": "me"}, 1)]


def test_jdbc_writer_settings(spark, monkeypatch):
    seen = {}

    class Writer:
        def format(self, kind):
            seen["format"] = kind
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def mode(self, mode):
            seen["mode"] = mode
            return self

        def save(self):
            seen["saved"] = True

    df = spark.range(1)
    monkeypatch.setattr(type(df), "write", property(lambda self: Writer()))
    jdbc.overwrite(df, "jdbc:x", "t", user="me")
    assert seen == {
        "format": "jdbc", "batchsize": "1000", "truncate": "true", "user": "me", "url": "jdbc:x", "dbtable": "t",
        "mode": "overwrite", "saved": True,
    }
    jdbc.append_rows(df, {"number": "id"}, "jdbc:x", "t")
    assert seen["mode"] == "append"


def test_jdbc_changes(spark, tmp_path):
    class FileConnection:
        """A DB-API look-alike that keeps a log of what it was asked to do."""

        def __init__(self, path):
            self.log = open(path, "a")

        def cursor(self):
            return self

        def executemany(self, text, many):
            for values in many:
                self.log.write(json.dumps([text.split()[0], values]) + "\n")

        def commit(self):
            self.log.write('["COMMIT"]\n')

        def rollback(self):
            self.log.write('["ROLLBACK"]\n')

        def close(self):
            self.log.close()

    log = spark.sql(
        "SELECT * FROM VALUES (1, 'u', 1L, 'limit', 1L, 2L, 0), (2, 'u', 3L, 'limit', 3L, 4L, 0), (-1, 'u', 5L, 'limit', 5L, NULL, 0)"
        " AS l(op, node_uri, last_abnormal_time, abnormal_type, abnormal_start_time, abnormal_end_time, batch_id)"
    ).coalesce(1)
    path = str(tmp_path / "log")
    jdbc.apply_changes(log, lambda: FileConnection(path), "abnormal_time_range", RANGE_KEY, commit_size=2)
    done = [json.loads(line) for line in open(path)]
    assert done == [
        ["INSERT", ["u", 1, "limit", 1, 2]],
        ["UPDATE", [3, 4, "u", 3, "limit"]],
        ["COMMIT"],
        ["DELETE", ["u", 5, "limit"]],
        ["COMMIT"],
    ]
    texts = jdbc.statements("t", ("k",), ("v",))
    assert texts[1][0] == "INSERT INTO t (k, v) VALUES (?, ?) ON CONFLICT (k) DO NOTHING"
    assert texts[2][0] == "UPDATE t SET v = ? WHERE k = ?"
    assert texts[-1][0] == "DELETE FROM t WHERE k = ?"


def test_short_json(spark):
    df = spark.sql("SELECT 'p' AS point_id, 1.5D AS v, 7L AS t")
    assert rows(keyed_json(df, SHORT_FIELDS), "key", "value") == [("p", '{"pointId":"p","v":1.5,"t":7}')]


def test_ntz_event_time_takes_a_watermark(spark, tmp_path):
    inbox = tmp_path / "in"
    drop_message(inbox, 1, ("a", 1, 1))
    stream = spark.readStream.schema("x STRING").text(str(inbox)).withColumn(
        "event_time", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")
    )
    assert jobs.with_watermark(stream, "5 minutes").schema["event_time"].dataType.simpleString() == "timestamp"
