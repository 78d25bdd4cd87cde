"""Merging of the keyed table's folders."""

import shutil

import pytest
from helpers import rows

from gaugeline.sinks import keyed_table
from gaugeline.sources import keyed

MINUTE = 1704067260000


def batch(spark, n):
    """Two points of its own and one that every batch puts again."""
    own = [(f"/gw/p{n}-{i}", float(n), MINUTE + 60_000 * i) for i in range(2)]
    return keyed_table.with_row_key(spark.createDataFrame([("/gw/all", float(n), MINUTE), *own], "uri STRING, v DOUBLE, t LONG"), 3)


def expected(batches):
    return sorted([("/gw/all", float(batches - 1)), *[(f"/gw/p{n}-{i}", float(n)) for n in range(batches) for i in range(2)]])


@pytest.mark.parametrize("partitions", [("salt",), ("year", "salt")])
def test_merges_keep_the_table_and_few_folders(spark, tmp_path, partitions):
    path = str(tmp_path / "table")
    for n in range(11):
        keyed_table.put(batch(spark, n), path, n, partitions)
        if n % 3 == 2:
            keyed_table.merge(spark, path, n, partitions, fan=2)
            assert rows(keyed_table.read(spark, path), "uri", "v") == expected(n + 1)
    parts = keyed_table.merge(spark, path, 10, partitions, fan=2)
    assert [(p.first, p.last) for p in parts] == [(0, 7), (8, 9), (10, 10)]
    assert rows(keyed_table.read(spark, path), "uri", "v") == expected(11)
    # A batch after the merge, and one repeated before it.
    keyed_table.put(batch(spark, 11), path, 11, partitions)
    keyed_table.put(batch(spark, 0), path, 0, partitions)
    assert rows(keyed_table.read(spark, path), "uri", "v") == expected(12)
    # What was merged goes with the next merge.
    keyed_table.merge(spark, path, 11, partitions, fan=2)
    keyed_table.merge(spark, path, 11, partitions, fan=2)
    assert rows(keyed_table.read(spark, path), "uri", "v") == expected(12)


def test_a_merge_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    for n in range(4):
        keyed_table.put(batch(spark, n), path, n)
    keyed_table.merge(spark, path, 1, fan=2)
    # The files of the next manifest exist, its mark doesn't.
    place = tmp_path / "table" / "_merged" / "manifest"
    shutil.copytree(place / "0000000000", place / "0000000001")
    (place / "0000000001" / "_SUCCESS").unlink()
    assert rows(keyed_table.read(spark, path), "uri", "v") == expected(4)
    keyed_table.merge(spark, path, 3, fan=2)
    assert rows(keyed_table.read(spark, path), "uri", "v") == expected(4)


def test_parts_of_points_and_empty_batches(spark, tmp_path):
    path = str(tmp_path / "table")
    layout = "uri STRING, part STRING, v DOUBLE, at LONG, t LONG"
    for n, own in enumerate(([("/u", "a", 1.0, 5, MINUTE)], [("/u", "b", 2.0, 9, MINUTE)], [], [("/u", "a", 3.0, 7, MINUTE)])):
        keyed_table.put(keyed_table.with_row_key(spark.createDataFrame(own, layout)), path, n)
    before = rows(keyed_table.read_parts(spark, path, "last"), "uri", "v")
    assert before == [("/u", 2.0)]
    (part,) = [p for p in keyed_table.merge(spark, path, 3, fan=3)]
    assert (part.first, part.last) == (0, 3)
    assert rows(keyed_table.read_parts(spark, path, "last"), "uri", "v") == before


def test_a_get_reads_its_salt_by_key_with_a_hash_aggregate(spark, tmp_path):
    path = str(tmp_path / "table")
    for n in range(3):
        keyed_table.put(batch(spark, n), path, n)
    keyed_table.merge(spark, path, 1, fan=2)
    (key,) = [r.row_key for r in keyed_table.read(spark, path).filter("uri = '/gw/all'").collect()]
    got = keyed.get(keyed_table.read(spark, path), key)
    assert rows(got, "v") == [(2.0,)]
    plan = got._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan
    assert plan.count("PartitionFilters: [isnotnull(salt") >= 2 and plan.count("PushedFilters: [IsNotNull(row_key)") >= 2
