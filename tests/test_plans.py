"""What the plans must look like for large and skewed data."""

import re

import pytest

import __spark_entry__ as entry
from gaugeline.operators import aggregates
from gaugeline.operators.discriminators import RULES
from gaugeline.operators.moving import moving_avg
from gaugeline.operators.runs import abnormal_ranges, annotate
from gaugeline.operators.slices import first_arrivals, with_neighbours
from gaugeline.plans import views
from gaugeline.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
BATCH_ONLY = [
    n
    for n in QUERIES
    if not n.startswith(("stateful", "stream", "sink", "src_readings", "watermark", "src_keyed", "keyed", "apply"))
    and not n.endswith("inorder")
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH_ONLY)
def test_no_python_and_no_cross_product(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert word not in text, word


def exchanges(text):
    return re.findall(r"hashpartitioning\(([^()]*)", text)


def test_no_reading_is_placed_by_point_alone(spark):
    """Only the edge table, one row per slice, is."""
    df = abnormal_ranges(views.judged(spark, SF_DIR, "cumulative"), RULES["cumulative"])
    keys = [re.sub(r"#\d+L?", "", e) for e in exchanges(plan(df))]
    assert sum(k.startswith("id, 4") or k == "id" for k in keys) == 1
    assert sum("slice_start" in k for k in keys) >= 3


def test_readings_are_shuffled_once(spark):
    df = abnormal_ranges(views.judged(spark, SF_DIR, "limit"), RULES["limit"])
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_all_rules_share_one_scan(spark):
    df = entry.queries()["abnormal_runs"](spark, SF_DIR)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1


def test_slices_hold_even_if_rows_lie_by_point(spark):
    rule = RULES["limit"]
    by_point = views.series(views.bound(spark, SF_DIR), rule).repartition(4, "id")
    for df in (annotate(by_point, rule), with_neighbours(by_point), moving_avg(by_point, 60)):
        assert re.search(r"hashpartitioning\(id#\d+, (slice_start|_block)", plan(df))


def test_scan_reads_what_is_needed(spark):
    df = first_arrivals(views.bound(spark, SF_DIR), ("id", "t"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(df)).group(1)
    assert "props" not in schema
    few = views.readings(spark, SF_DIR).filter("point_id = 'click'").select("seq")
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan(few)
    assert "EqualTo(event_type,click)" in plan(few)


def test_window_values_are_hashed_and_combined_first(spark):
    bound = views.bound(spark, SF_DIR)
    text = plan(aggregates.window_last(bound, tie="seq"))
    assert "SortAggregate" not in text
    assert text.count("HashAggregate") == 2 and "partial_max_by" in text


@pytest.mark.parametrize("name", ["abnormal_runs", "change_log"])
def test_rules_and_versions_are_judged_in_one_pass(spark, name):
    """One scan, and one exchange that deals readings by slice; the edge table uses it again."""
    df = QUERIES[name](spark, SF_DIR)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1
    dealt = [line for line in final.splitlines() if "Exchange hashpartitioning(id" in line and "REPARTITION_BY_COL" in line]
    assert len([line for line in dealt if "ReusedExchange" not in line]) == 1
    assert "FullOuter" not in final


def test_ring_ratio_reads_its_series_once(spark):
    df = QUERIES["ring_ratio"](spark, SF_DIR)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1
    assert len([x for x in final.splitlines() if " Exchange hashpartitioning(" in x]) == 2


def test_totals_of_long_windows_combine_before_the_shuffle(spark):
    """Readings are dealt to parts once; the edge table's rows are partial sums."""
    text = plan(QUERIES["moving_sum_week"](spark, SF_DIR))
    assert text.count("REPARTITION_BY_COL") == 1 and "partial_sum" in text


@pytest.mark.parametrize("name", ["past_day_report", "src_versions"])
def test_time_ranges_reach_the_scan(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
