"""One mark for all outputs of a batch, and tables kept as a snapshot and the log after it."""

import pytest

from gaugeline.operators.discriminators import RULES
from gaugeline.sinks.rows import lines_writer
from gaugeline.streaming import incremental
from gaugeline.streaming.incremental import IncrementalMovingAvg, IncrementalRuns
from gaugeline.streaming.minutes import RunningWindows
from gaugeline.streaming.state import BucketedState
from helpers import parse, rows, series

BATCHES = [
    parse("p", "1:20 2:20 4:20 5:1") + parse("q", "1:20"),
    parse("p", "3:5 7:30") + parse("q", "3:1"),
    parse("p", "6:40 8:1") + parse("q", "2:30 4:20"),
    parse("p", "9:20") + parse("q", "5:1"),
]


def batch(spark, n):
    return series(spark, BATCHES[n], first_seq=sum(map(len, BATCHES[:n])))


def tables(spark, runs):
    return [rows(runs.table(spark, kind), "*") for kind in ("points", "ranges")]


@pytest.fixture(scope="module")
def expected(spark, tmp_path_factory):
    """Both tables after each batch of a run without failures or snapshots."""
    runs = IncrementalRuns(RULES["limit"], str(tmp_path_factory.mktemp("plain")), 1000, buckets=4)
    out = []
    for n in range(len(BATCHES)):
        runs(batch(spark, n), n)
        out.append(tables(spark, runs))
    return out


@pytest.mark.parametrize("broken", ["points", "ranges", "tail", "mark"])
def test_outputs_are_valid_together(spark, tmp_path, monkeypatch, expected, broken):
    """A batch that fails anywhere shows none of its rows, and is repeated without doubles or gaps."""
    runs = IncrementalRuns(RULES["limit"], str(tmp_path), 1000, buckets=4)
    runs(batch(spark, 0), 0)
    with monkeypatch.context() as patch:
        if broken in ("points", "ranges"):
            whole = incremental.output

            def output(df, root, kind, batch_id):
                whole(df, root, kind, batch_id)
                if kind == broken:
                    raise OSError("lost")

            patch.setattr(incremental, "output", output)
        elif broken == "tail":
            patch.setattr(BucketedState, "save", lambda *args: (_ for _ in ()).throw(OSError("lost")))
        else:
            patch.setattr("gaugeline.streaming.state.write_note", lambda *args: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            runs(batch(spark, 1), 1)
    assert tables(spark, runs) == expected[0]
    runs(batch(spark, 1), 1)
    assert tables(spark, runs) == expected[1]


def test_snapshots_change_no_table(spark, tmp_path, expected):
    runs = IncrementalRuns(RULES["limit"], str(tmp_path), 1000, buckets=4)
    runs.snapshot(spark)  # nothing yet
    for n in range(len(BATCHES)):
        runs(batch(spark, n), n)
        assert tables(spark, runs) == expected[n]
        runs.snapshot(spark)
        runs.snapshot(spark)
        assert tables(spark, runs) == expected[n]
        # A batch that ended may still be repeated.
        runs(batch(spark, n), n)
        assert tables(spark, runs) == expected[n]
    # The newest snapshot and the one before it, for its readers.
    assert sorted(p.name for p in (tmp_path / "ranges-snapshot").iterdir() if p.name.startswith("rows")) == ["rows-2", "rows-3"]


def test_a_read_opens_the_snapshot_and_what_came_later(spark, tmp_path, expected):
    runs = IncrementalRuns(RULES["limit"], str(tmp_path), 1000, buckets=4)
    for n in range(len(BATCHES)):
        runs(batch(spark, n), n)
        if n == 2:
            runs.snapshot(spark)
    for kind in ("points", "ranges"):
        opened = {file.rpartition("/")[0].rpartition("/")[2] for file in runs.table(spark, kind).inputFiles()}
        assert opened == {"rows-2", "batch_id=3"}
    assert tables(spark, runs) == expected[3]


def test_a_snapshot_that_was_not_marked_is_not_read(spark, tmp_path, monkeypatch, expected):
    runs = IncrementalRuns(RULES["limit"], str(tmp_path), 1000, buckets=4)
    for n in (0, 1):
        runs(batch(spark, n), n)
    with monkeypatch.context() as patch:
        patch.setattr("gaugeline.streaming.state.write_note", lambda *args: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            runs.snapshot(spark)
    assert tables(spark, runs) == expected[1]
    runs.snapshot(spark)
    assert tables(spark, runs) == expected[1]


def test_before_the_first_batch_ends(spark, tmp_path, monkeypatch):
    runs = IncrementalRuns(RULES["limit"], str(tmp_path), 1000, buckets=4)
    with monkeypatch.context() as patch:
        patch.setattr(BucketedState, "save", lambda *args: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            runs(batch(spark, 0), 0)
    assert tables(spark, runs) == [[], []]


@pytest.mark.parametrize("build", [
    lambda root: IncrementalMovingAvg(root, 1000, 3, buckets=4),
    lambda root: RunningWindows(root, 1000, 3, buckets=4),
])
def test_averages_and_windows_from_snapshots(spark, tmp_path, build):
    plain, folded = build(str(tmp_path / "plain")), build(str(tmp_path / "folded"))
    for n in range(len(BATCHES)):
        plain(batch(spark, n), n)
        folded(batch(spark, n), n)
        if n in (0, 2):
            folded.snapshot(spark)
        columns = plain.table(spark).columns
        assert rows(folded.table(spark), *columns) == rows(plain.table(spark), *columns)
    opened = {file.rpartition("/")[0].rpartition("/")[2] for file in folded.table(spark).inputFiles()}
    assert opened == {"rows-2", "batch_id=3"}


def test_a_repeated_epoch_replaces_its_lines(spark, tmp_path):
    """Rows handed to a client: a failed attempt leaves nothing that its repetition does not replace."""
    given = spark.sql("SELECT * FROM VALUES (1L, 'a'), (2L, NULL), (3L, 'c\nd') AS r(n, s)").collect()
    for attempt in (given[:2], given):
        writer = lines_writer(str(tmp_path / "lines"), group=2)
        assert writer.open(0, 7)
        for row in attempt:
            writer.process(row)
        writer.close(OSError("lost") if attempt is not given else None)
    other = lines_writer(str(tmp_path / "lines"))
    other.open(0, 8)
    other.close(None)
    stored = spark.read.schema("n BIGINT, s STRING").json(str(tmp_path / "lines" / "epoch=*"))
    assert rows(stored, "n", "s") == rows(spark.createDataFrame(given), "n", "s")
