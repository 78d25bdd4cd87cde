"""Readings and rules derived from the driver's tables, as DataFrames.

``plans.oracle`` states the same views in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.times import ntz_millis, stored_between
from gaugeline.operators.discriminators import RULES, Discriminator, renamed
from gaugeline.operators.runs import annotate, judge
from gaugeline.operators.slices import SLICE, first_arrivals, with_slice
from gaugeline.sources.rules import join_rules

# Fixed values of the test rules: point, lowerbound, upperbound, amp, switch_default.
RULE_ROWS = [
    ("click", "2.5", "140", "0.5", "1"),
    ("purchase", "5", "100", "1.0", "0"),
    ("error", "10", "90", "2.0", "20"),
    ("signup", "0", "300", "0.8", "35"),
]
# A second version of the upper bounds, for change logs.
NEW_UPPER = {"click": "60", "purchase": "150", "error": "40", "signup": "20"}
GATEWAYS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings_of(events: DataFrame) -> DataFrame:
    gateway = F.concat(F.lit("gw"), (F.col("user_id") % GATEWAYS).cast("string"))
    point = F.col("event_type")
    value = F.col("value")
    raw = (
        F.when(point == "error", "S#down")
        .when(point == "signup", F.when(value >= 35, "B#true").otherwise("B#false"))
        .otherwise(F.concat(F.lit("F#"), value.cast("string")))
    )
    return events.select(
        F.col("event_id").alias("seq"),
        gateway.alias("gateway_id"),
        F.concat(F.lit("ns"), (F.col("user_id") % 2).cast("string")).alias("namespace"),
        point.alias("point_id"),
        F.concat(F.lit("/"), gateway, F.lit("/"), point).alias("id"),
        ntz_millis(F.col("ts")).alias("t"),
        value.alias("v"),
        raw.alias("raw_v"),
        F.lit("good").alias("s"),
    )


def readings(spark: SparkSession, sf_dir: str, start: Column | None = None, stop: Column | None = None) -> DataFrame:
    """All readings, or those with ``start <= t < stop``, a range of the stored time."""
    events = table(spark, sf_dir, "events")
    if start is not None and stop is not None:
        events = events.filter(stored_between(F.col("ts"), start, stop))
    return readings_of(events)


def rules(spark: SparkSession, new: bool = False) -> DataFrame:
    # Literal rows in the plan: Spark knows their size, unlike that of a parallelised collection.
    rows = ", ".join(
        f"('/gw{g}/{p}', '/plant/gw{g}/{p}', '{lower}', '{NEW_UPPER[p] if new else upper}', '{amp}', '{switch}')"
        for g in range(GATEWAYS)
        for p, lower, upper, amp, switch in RULE_ROWS
    )
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS rule(id, uri, lowerbound, upperbound, amp, switch_default)"
    )


def bound(spark: SparkSession, sf_dir: str, new_rules: bool = False) -> DataFrame:
    """Readings that have a rule."""
    return join_rules(readings(spark, sf_dir), rules(spark, new_rules)).filter("id IS NOT NULL")


def series(bound_readings: DataFrame, *rules_used: Discriminator) -> DataFrame:
    """First arrivals with what the rules need. The parameters belong to the id, so they ride along
    as grouping columns."""
    params = dict.fromkeys(p for rule in rules_used for p in rule.params)
    keys = ["id", "uri", *params, SLICE, "t"]
    return first_arrivals(with_slice(bound_readings), keys).drop(SLICE, "seq")


def judged(spark: SparkSession, sf_dir: str, name: str, new_rules: bool = False) -> DataFrame:
    rule = RULES[name]
    return annotate(series(bound(spark, sf_dir, new_rules), rule), rule)


def judged_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule over one series, in one pass."""
    rules_used = list(RULES.values())
    return judge(series(bound(spark, sf_dir), *rules_used), rules_used)


# The limit rule over the second version of the bounds.
NEW_BOUNDS = {"upperbound": "new_upperbound", "lowerbound": "new_lowerbound"}
LIMIT_VERSIONS = (RULES["limit"], renamed(RULES["limit"], NEW_BOUNDS))


def judged_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series under both versions of the limit rule."""
    second = rules(spark, new=True).select("id", *[F.col(c).alias(new) for c, new in NEW_BOUNDS.items()])
    both = join_rules(readings(spark, sf_dir), rules(spark).join(second, "id")).filter("id IS NOT NULL")
    return judge(series(both, *LIMIT_VERSIONS), LIMIT_VERSIONS)
