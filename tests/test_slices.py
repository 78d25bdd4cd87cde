"""Slices cut by the density of a point."""

import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import comparisons
from gaugeline.operators.discriminators import RULES
from gaugeline.operators.runs import annotate, judge
from gaugeline.operators.slices import SLICE, dense_cuts, with_neighbours, with_slice
from gaugeline.sources import rules as rule_source
from helpers import rows, series

CUT = {"slice_ms": 1000, "cell_ms": 10, "most": 25}


def bursty(seed=5):
    """One point with nearly all readings, most of them within a tenth of its time, and two sparse ones."""
    draw = random.Random(seed)
    hot = set(draw.sample(range(-300, 4000), 150)) | set(draw.sample(range(2100, 2500), 350))
    points = {"hot": sorted(hot), "a": draw.sample(range(4000), 12), "b": [5]}
    return [(p, t, float(draw.choice([1, 2, 5, 20, 30]))) for p, times in points.items() for t in times]


@pytest.fixture(scope="module")
def df(spark):
    return series(spark, bursty()).persist()


def test_only_dense_slices_are_cut(spark, df):
    cuts = dense_cuts(df, **CUT)
    found = {(r._slice.id, r._slice[SLICE]): r._cuts for r in cuts.collect()}
    counts = {}
    for point, t, _ in bursty():
        counts[f"/g/{point}", t - t % 1000] = counts.get((f"/g/{point}", t - t % 1000), 0) + 1
    assert set(found) == {where for where, n in counts.items() if n > CUT["most"]}
    for (_, start), begins in found.items():
        assert begins == sorted(set(begins)) and all(start <= b < start + 1000 and b % 10 == 0 for b in begins)


def test_pieces_are_bounded_and_follow_each_other(spark, df):
    cut = with_slice(df, slice_ms=CUT["slice_ms"], cuts=dense_cuts(df, **CUT))
    assert cut.count() == df.count()
    pieces = cut.groupBy("id", SLICE).agg(F.count("*").alias("n"), F.min("t").alias("a"), F.max("t").alias("z")).collect()
    assert max(p.n for p in pieces) < CUT["most"] + CUT["cell_ms"]
    for point in {p.id for p in pieces}:
        own = sorted((p[SLICE], p.a, p.z) for p in pieces if p.id == point)
        assert all(start <= a <= z for start, a, z in own)
        assert all(one[2] < two[0] for one, two in zip(own, own[1:]))


def test_no_dense_slice_no_cuts(spark, df):
    assert dense_cuts(df, slice_ms=1000, cell_ms=10, most=10_000) is None
    assert dense_cuts(df.limit(0), **CUT) is None


def test_a_slice_with_exactly_the_most_is_not_cut(spark):
    full = series(spark, [("p", t, 1) for t in range(25)])
    assert dense_cuts(full, **CUT) is None
    over = dense_cuts(series(spark, [("p", t, 1) for t in range(26)]), **CUT)
    # The third cell begins below the bound, so all lie in one piece: it may exceed the bound by a cell.
    assert over.first()._cuts == [0]


@pytest.mark.parametrize("name", list(RULES))
def test_rules_over_pieces(spark, df, name):
    columns = ("id", "t", "previous_value", "abnormal", "exception_start_time", "exception_end_time")
    cuts = dense_cuts(df, **CUT)
    whole = rows(annotate(df, RULES[name], slice_ms=1000), *columns)
    assert rows(annotate(df, RULES[name], slice_ms=1000, cuts=cuts), *columns) == whole


def test_all_rules_and_neighbours_over_pieces(spark, df):
    cuts = dense_cuts(df, **CUT)
    both = list(RULES.values())[:2]
    assert rows(judge(df, both, slice_ms=1000, cuts=cuts), "*") == rows(judge(df, both, slice_ms=1000), "*")
    plain = df.select("id", "t", "v")
    assert rows(with_neighbours(plain, slice_ms=1000, cuts=cuts), "*") == rows(with_neighbours(plain, slice_ms=1000), "*")
    for build in (comparisons.previous_reading, comparisons.neighbour_diff):
        assert rows(build(plain, slice_ms=1000, cuts=cuts), "*") == rows(build(plain, slice_ms=1000), "*")


def test_cuts_beyond_the_broadcast_bound(spark, df, monkeypatch):
    cuts = dense_cuts(df, **CUT)
    near = rows(with_slice(df, slice_ms=1000, cuts=cuts), "id", "t", SLICE)
    monkeypatch.setattr(rule_source, "fits_broadcast", lambda small: False)
    assert rows(with_slice(df, slice_ms=1000, cuts=cuts), "id", "t", SLICE) == near


def test_keys_of_several_columns(spark, df):
    cuts = dense_cuts(df, ("id", "uri"), **CUT)
    cut = with_slice(df, slice_ms=1000, cuts=cuts, key=("id", "uri"))
    assert rows(cut, "id", "t", SLICE) == rows(with_slice(df, slice_ms=1000, cuts=dense_cuts(df, **CUT)), "id", "t", SLICE)


def test_a_dense_point_is_dealt_evenly(spark):
    """95 % of the rows are one point's, within two days: whole days would be two tasks, pieces are many."""
    # 1 reading a second over two days for the hot point, a minute apart for nine others.
    hot = spark.range(0, 172_800).selectExpr("'hot' AS id", "id * 1000 AS t", "CAST(id % 7 AS DOUBLE) AS v")
    rest = spark.range(0, 9_000).selectExpr("concat('p', id % 9) AS id", "(id DIV 9) * 60000 AS t", "1D AS v")
    both = hot.unionByName(rest)
    cuts = dense_cuts(both, most=1_000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        linked = with_neighbours(both, cuts=cuts)
        dealt = [r["count"] for r in linked.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(dealt) == 4 and max(dealt) < 2 * median(dealt)
    assert linked.filter("before IS NULL").count() == 10
