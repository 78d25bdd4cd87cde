"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs to the end into a sink that discards rows, once to warm up and once timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from gaugeline.plans.queries import QUERIES
from gaugeline.session import build_session

HEADLINE = [
    "src_parse_array",
    "src_rules",
    "join_rules",
    "disc_limit",
    "abnormal_ranges_limit",
    "abnormal_ranges_switch",
    "abnormal_ranges_cumulative",
    "abnormal_ranges_amplitude",
    "abnormal_runs",
    "change_log",
    "minute_last",
    "minute_avg",
    "minute_last_ingest",
    "sliding_last_point",
    "moving_avg",
    "ring_ratio",
    "previous_reading",
    "neighbour_diff",
    "interval_rollup",
    "exact_decimal",
    "sink_keyed_table",
    "stateful_disc_limit",
    "stateful_moving_avg",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    seconds: dict[str, float] = {}
    for name in wanted:
        for _ in range(2):
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - begin, 3)
    total = round(sum(seconds.values()), 3)
    result = {
        "metric": "seconds for all headline queries, warm",
        "value": total,
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "events": events,
        "readings_per_second": {
            name: round(events / seconds[name])
            for name in ("abnormal_ranges_limit", "minute_last", "moving_avg", "stateful_disc_limit")
            if name in seconds
        },
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
