"""The keyed minute table, kept as batches of puts that reads merge.

A put appends a folder ``batch_id=N`` (replaced when the batch is repeated), so writing costs what the
batch holds, not what the table holds. ``read`` keeps the newest put per key. Files are in order of key, so
a get or scan of keys skips row groups and pages by their bounds.

``merge`` keeps reads cheap: whenever ``FAN`` neighbouring folders of one size class exist, they become one of the
next class, so a table of n batches has a few folders per class and a row is rewritten log n times. What folders
count is said by a manifest, which is written last; a failure before that leaves the table as it was. Folders that
were merged are removed by the next merge, so that reads under way end well. ``compact`` writes the merged
table to a new place.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions import keys
from gaugeline.functions.times import event_time
from gaugeline.operators.aggregates import merge_parts
from gaugeline.session import drop_folder

# Folders of one size class that become one of the next.
FAN = 8
MERGED = "_merged"
# Columns that follow from a row key: its salt, its year and, as long as ``t`` has 13 digits, its uri.
FOLLOWING = ("salt", "year", "uri")


def with_row_key(windowed: DataFrame, regions: int = 100) -> DataFrame:
    """Adds ``salt``, ``row_key`` and ``year`` to rows of ``uri, v, t``.

    The hash of a uri is taken once per row but never per reading: the rows are window results.
    """
    return (
        windowed.withColumn("salt", keys.salt(F.col("uri"), regions))
        .withColumn("row_key", keys.row_key(F.col("uri"), F.col("t"), F.col("salt")))
        .withColumn("year", F.year(event_time(F.col("t"))).cast("int"))
    )


def put(rows: DataFrame, path: str, batch_id: int, partitions: Sequence[str] = ("salt",), **options: str) -> None:
    """Write the rows of a batch; the same batch again replaces itself."""
    (
        rows.repartition(*partitions, F.floor(F.col("t") / 86_400_000))
        .sortWithinPartitions(*partitions, "row_key")
        .write.mode("overwrite")
        .options(**options)
        .partitionBy(*partitions)
        .parquet(f"{path}/batch_id={batch_id}")
    )


def put_by_year(rows: DataFrame, path: str, batch_id: int) -> None:
    """As ``put``, routed to a folder per year of ``t``."""
    put(rows, path, batch_id, ("year", "salt"))


def latest(puts: DataFrame, key: Sequence[str] = ("row_key",), order: Sequence[str] = ("batch_id",)) -> DataFrame:
    """The newest put per key. What follows from the key stays a grouping column: filters on the salt still prune
    folders, and the values are plain columns, which a hash aggregate takes."""
    by = [*key, *[c for c in FOLLOWING if c in puts.columns and c not in key]]
    rest = [c for c in puts.columns if c not in (*by, *order)]
    newest = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return puts.groupBy(*by).agg(*[F.max_by(c, newest).alias(c) for c in rest])


@dataclass
class Part:
    """A folder below the table that counts, for the batches ``first`` to ``last``."""

    folder: str
    first: int
    last: int
    size_class: int = 0


@dataclass
class Manifest:
    """What a merge left: the folders of all batches up to ``upto``, and those that nothing needs any more."""

    version: int = -1
    upto: int = -1
    parts: list[Part] = field(default_factory=list)
    gone: list[str] = field(default_factory=list)


def _names(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().getName() for f in found or [])


def _holds_rows(spark: SparkSession, folder: str) -> bool:
    return bool(_names(spark, f"{folder}/*=*"))


def _manifest(spark: SparkSession, path: str) -> Manifest:
    """The newest one that was written to the end."""
    place = f"{path}/{MERGED}/manifest"
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    for name in reversed(_names(spark, f"{place}/*")):
        done = path_of(f"{place}/{name}/_SUCCESS")
        if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
            found = json.loads(spark.read.schema("manifest STRING").parquet(f"{place}/{name}").first()["manifest"])
            return Manifest(**{**found, "parts": [Part(**p) for p in found["parts"]]})
    return Manifest()


def _batches(spark: SparkSession, path: str, after: int) -> list[int]:
    return sorted(n for n in (int(x.partition("=")[2]) for x in _names(spark, f"{path}/batch_id=*")) if n > after)


def _open(spark: SparkSession, path: str, parts: Sequence[Part]) -> DataFrame:
    plain = [f"{path}/{p.folder}" for p in parts if not p.folder.startswith(MERGED)]
    frames = [spark.read.option("basePath", path).parquet(*plain)] if plain else []
    frames += [spark.read.parquet(f"{path}/{p.folder}") for p in parts if p.folder.startswith(MERGED)]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def live(spark: SparkSession, path: str) -> list[Part]:
    """The folders a reader has to open."""
    known = _manifest(spark, path)
    return known.parts + [Part(f"batch_id={n}", n, n) for n in _batches(spark, path, known.upto)]


def puts(spark: SparkSession, path: str) -> DataFrame:
    """All puts that count, with their ``batch_id``."""
    if not _names(spark, f"{path}/{MERGED}"):
        return spark.read.parquet(path)
    return _open(spark, path, live(spark, path))


def read(spark: SparkSession, path: str) -> DataFrame:
    return latest(puts(spark, path))


def read_parts(spark: SparkSession, path: str, how: str) -> DataFrame:
    """A table whose rows have a part per point: the newest of each part, then the value of all parts of a key.

    Of parts with the same last time the one with the highest name counts.
    """
    newest = latest(puts(spark, path), ("row_key", "part"))
    folders = [c for c in ("salt", "year") if c in newest.columns]
    return merge_parts(newest, ["row_key", *folders, "uri", "t"], how, ["part"])


def merge(spark: SparkSession, path: str, upto: int, partitions: Sequence[str] = ("salt",), fan: int = FAN) -> list[Part]:
    """Merge folders of batches up to ``upto``, the last one that won't be repeated; the folders that count then.

    One merge at a time. Batches up to ``upto`` that are put again afterwards are not looked at. The merged files carry a
    Bloom filter of their keys, so a get opens the pages of the files that hold the key.
    """
    before = _manifest(spark, path)
    for folder in before.gone:
        drop_folder(spark, f"{path}/{folder}")
    new = [n for n in _batches(spark, path, before.upto) if n <= upto]
    kept = [Part(f"batch_id={n}", n, n) for n in new if _holds_rows(spark, f"{path}/batch_id={n}")]
    # Groups of neighbours that become one folder; a group of one stays as it is.
    groups: list[tuple[int, list[Part]]] = []
    for part in before.parts + kept:
        groups.append((part.size_class, [part]))
        while len(groups) >= fan and all(size == groups[-1][0] for size, _ in groups[-fan:]):
            joined = [p for _, members in groups[-fan:] for p in members]
            groups[-fan:] = [(groups[-1][0] + 1, joined)]
    after = Manifest(before.version + 1, max(upto, before.upto))
    bloom = {"parquet.bloom.filter.enabled#row_key": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
    for size_class, members in groups:
        if len(members) == 1:
            after.parts.append(members[0])
            continue
        first, last = members[0].first, members[-1].last
        rows = _open(spark, path, members)
        key = [c for c in ("row_key", "part") if c in rows.columns]
        folder = f"{MERGED}/{first}-{last}-{uuid.uuid4().hex}"
        put(latest(rows, key), f"{path}/{folder}", last, partitions, **bloom)
        after.parts.append(Part(folder, first, last, size_class))
        after.gone += [m.folder for m in members]
    if after.upto > before.upto or after.parts != before.parts:
        text = json.dumps(asdict(after))
        mark = spark.range(1, numPartitions=1).select(F.lit(text).alias("manifest"))
        mark.write.mode("overwrite").parquet(f"{path}/{MERGED}/manifest/{after.version:010d}")
        for old in _names(spark, f"{path}/{MERGED}/manifest/*")[:-2]:
            drop_folder(spark, f"{path}/{MERGED}/manifest/{old}")
    return after.parts


def compact(spark: SparkSession, path: str, target: str, partitions: Sequence[str] = ("salt",)) -> None:
    """Write the merged table as batch 0 of a new place."""
    put(read(spark, path), target, 0, partitions)


def delete_keys(table: DataFrame, gone: DataFrame, key: str = "row_key") -> DataFrame:
    return table.join(gone.select(key), key, "left_anti")


def clear_column(table: DataFrame, gone: DataFrame, column: str, key: str = "row_key") -> DataFrame:
    """NULL in ``column`` for the keys of ``gone``."""
    marked = table.join(gone.select(key).distinct().withColumn("_hit", F.lit(True)), key, "left")
    cleared: Column = F.when(F.col("_hit").isNull(), F.col(column))
    return marked.withColumn(column, cleared).drop("_hit").select(*table.columns)


def drop_family(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    return table.drop(*columns)


def truncated(table: DataFrame) -> DataFrame:
    """The table's layout without rows."""
    return table.filter(F.lit(False))
