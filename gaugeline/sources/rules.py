"""Rules and their binding to points."""

from __future__ import annotations

import re
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.sources.schemas import RULE_DOCUMENT

# Parameter paths of the built-in rules.
LIMIT_PARAMS = {"upperbound": "$.0.value", "lowerbound": "$.1.value"}
SWITCH_PARAMS = {"switch_default": "$.0.value"}
AMPLITUDE_PARAMS = {"amp": "$.0.value"}
# Bounds of a table that may be broadcast, and the spread of a join beyond them.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
SPREAD = 32


def params_from_options(options: dict[str, str], prefix: str) -> dict[str, str]:
    """Rule columns named by options ``<prefix><name>`` -> path."""
    return {name.removeprefix(prefix): path for name, path in options.items() if name.startswith(prefix)}


def json_path(path: str) -> str:
    """``$.0.value`` in the notation of ``get_json_object``: ``$[0].value``."""
    return re.sub(r"\.(\d+)(?=\.|$|\[)", r"[\1]", path)


def parse_rules(
    documents: DataFrame, params: dict[str, str], value: str = "value", order: str | None = None
) -> DataFrame:
    """Rule documents -> ``id, uri`` and a text column per parameter; the last of equal ids wins.

    Last means latest ``order`` (of the document), then place in the document.
    """
    parsed = F.from_json(F.col(value), RULE_DOCUMENT)
    order_by = F.col(order) if order else F.lit(0)
    points = (
        documents.select(order_by.alias("_doc"), F.posexplode(parsed["data"]).alias("_entry", "entry"))
        .select("_doc", "_entry", "entry.instanceParams", F.posexplode("entry.points").alias("_place", "point"))
        .select(
            "point.id",
            F.struct("_doc", "_entry", "_place").alias("_at"),
            F.struct(
                "point.uri",
                *[F.get_json_object("instanceParams", json_path(p)).alias(n) for n, p in params.items()],
            ).alias("rule"),
        )
        .filter("id IS NOT NULL")
    )
    return points.groupBy("id").agg(F.max_by("rule", "_at").alias("rule")).select("id", "rule.*")


def unreadable_rules(documents: DataFrame, value: str = "value") -> DataFrame:
    """Documents that hold no rule list."""
    return documents.filter(F.from_json(F.col(value), RULE_DOCUMENT)["data"].isNull())


def rule_id(gateway_id: Column, point_id: Column) -> Column:
    return F.concat(F.lit("/"), gateway_id, F.lit("/"), point_id)


def fits_broadcast(small: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a table is proven small: counted and weighed by one aggregate over all of it."""
    weight = reduce(add, [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in small.columns])
    found = small.agg(F.count("*").alias("n"), F.sum(weight + 16 * len(small.columns)).alias("size")).first()
    return found["n"] <= rows and (found["size"] or 0) <= size


def lookup(facts: DataFrame, small: DataFrame, key: Column, small_key: str, how: str) -> DataFrame:
    """Join ``facts`` to ``small``, which has one row per ``small_key``.

    Broadcast when ``small`` is proven small. Beyond that both sides shuffle, the facts of
    a key spread over ``SPREAD`` parts and ``small`` repeated for each, so that a key holding a large share
    of the facts is no task's burden.
    """
    wanted = small.withColumn("_key", F.col(small_key))
    if small_key in facts.columns:
        wanted = wanted.drop(small_key)
    if fits_broadcast(small):
        return facts.join(F.broadcast(wanted), key == wanted["_key"], how).drop("_key")
    parts = F.sequence(F.lit(0), F.lit(SPREAD - 1))
    wanted = wanted.withColumn("_part", F.explode(parts))
    spread = facts.withColumn("_own_key", key).withColumn("_own_part", F.pmod(F.xxhash64(*facts.columns), F.lit(SPREAD)))
    on = (spread["_own_key"] == wanted["_key"]) & (spread["_own_part"] == wanted["_part"])
    return spread.join(wanted, on, how).drop("_own_key", "_own_part", "_key", "_part")


def join_rules(readings: DataFrame, rules: DataFrame) -> DataFrame:
    """Every reading with its rule (one per id), NULLs where none is bound."""
    bare = readings.drop(*[c for c in rules.columns if c in readings.columns])
    return lookup(bare, rules, rule_id(F.col("gateway_id"), F.col("point_id")), "id", "left")


def split_bound(joined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readings with a rule, readings that pass through)."""
    return joined.filter("id IS NOT NULL"), joined.filter("id IS NULL")


def join_limits(readings: DataFrame, limits: DataFrame, key: str = "namespace") -> DataFrame:
    """Readings that have limits for their namespace. ``limits`` holds one row per namespace."""
    return lookup(readings, limits, F.col(key), key, "inner")


def three_way(judged: DataFrame, status: str = "status") -> tuple[DataFrame, DataFrame]:
    """(not ok, ok or not judged)."""
    s = F.col(status)
    return judged.filter(~s), judged.filter(s | s.isNull())
