"""Reads of the keyed table: Parquet, partitioned by ``salt`` (and ``year``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeline.functions.keys import SALT_DIGITS

_SPREAD = 64


def open_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _salt_of(key: str) -> int | None:
    head = key[:SALT_DIGITS]
    return int(head) if len(head) == SALT_DIGITS and head.isdigit() else None


def get(table: DataFrame, key: str, condition: Column | None = None) -> DataFrame:
    """The row of one key. The salt in the key names the partition, so only that one is read."""
    rows = table.filter(F.col("row_key") == key)
    salt = _salt_of(key)
    if "salt" in table.columns and salt is not None:
        rows = rows.filter(F.col("salt") == salt)
    return rows if condition is None else rows.filter(condition)


def scan(
    table: DataFrame,
    start: str | None = None,
    stop: str | None = None,
    condition: Column | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Rows with ``start <= row_key < stop``, filtered, with the wanted columns only."""
    rows = table
    salted = "salt" in table.columns
    if start is not None:
        rows = rows.filter(F.col("row_key") >= start)
        if salted and _salt_of(start) is not None:
            rows = rows.filter(F.col("salt") >= _salt_of(start))
    if stop is not None:
        rows = rows.filter(F.col("row_key") < stop)
        if salted and _salt_of(stop) is not None:
            rows = rows.filter(F.col("salt") <= _salt_of(stop))
    if condition is not None:
        rows = rows.filter(condition)
    return rows.select(*columns) if columns else rows


def versions(
    cells: DataFrame,
    key: list[str],
    stamp: str = "ts",
    max_versions: int = 1,
    min_stamp: int | None = None,
    max_stamp: int | None = None,
    tie: str | None = None,
) -> DataFrame:
    """The newest ``max_versions`` rows per key, with ``min_stamp <= stamp < max_stamp``.

    One version is an aggregate. More are ranked, first within each of ``_SPREAD`` parts of a key and
    then among the survivors, so that a key with very many versions never meets in one task.
    """
    rows = cells
    if min_stamp is not None:
        rows = rows.filter(F.col(stamp) >= min_stamp)
    if max_stamp is not None:
        rows = rows.filter(F.col(stamp) < max_stamp)
    order = [stamp, *([tie] if tie else [])]
    if max_versions == 1:
        rest = [c for c in cells.columns if c not in key]
        newest = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("newest"))
        return newest.select(*key, *[F.col(f"newest.{c}").alias(c) for c in rest]).select(*cells.columns)
    newest_first = [F.desc(c) for c in order]
    part = F.pmod(F.xxhash64(*order), F.lit(_SPREAD))
    for spread in ([*key, part], key):
        rank = F.row_number().over(Window.partitionBy(*spread).orderBy(*newest_first))
        rows = rows.withColumn("_rank", rank).filter(F.col("_rank") <= max_versions).drop("_rank")
    return rows

