"""A table carried from batch to batch in buckets of points; a batch rewrites the buckets it touches and no other.

Rows lie in ``<kind>/batch_id=N/bucket=B``, in the batch that last wrote the bucket. The *manifest* of a batch says where each
bucket is, when it is next *due* although none of its points reports, and the latest event time. Manifests
alternate between two slots: batch N reads that of N-1 and replaces only what N wrote before, so a batch may be
repeated after a failure. What no manifest names any more is removed one batch later.

A bucket is a folder, not a task: its files are dealt by size, so a busy point costs no more than its rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.session import drop_folder

BUCKET = "bucket"


@dataclass
class Manifest:
    """After ``batch_id``: the latest event time, and per bucket the batch that wrote it and its due time."""

    batch_id: int = -1
    latest: int | None = None
    schema: str | None = None
    places: dict[int, int] = field(default_factory=dict)
    due: dict[int, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(self.__dict__)

    @classmethod
    def of(cls, text: str) -> Manifest:
        found = json.loads(text)
        for name in ("places", "due"):
            found[name] = {int(k): v for k, v in found[name].items()}
        return cls(**found)


class BucketedState:
    def __init__(self, root: str, kind: str = "tail", buckets: int = 64, key: str = "id") -> None:
        self.root = root.rstrip("/")
        self.kind = kind
        self.buckets = buckets
        self.key = key

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _manifest(self, batch_id: int) -> str:
        return f"{self.root}/{self.kind}-manifest/{batch_id % 2}"

    def _folder(self, batch_id: int, bucket: int | None = None) -> str:
        base = f"{self.root}/{self.kind}/batch_id={batch_id}"
        return base if bucket is None else f"{base}/{BUCKET}={bucket}"

    def _stored(self, spark: SparkSession, batch_id: int) -> Manifest | None:
        text = read_note(spark, self._manifest(batch_id))
        return None if text is None else Manifest.of(text)

    def last(self, spark: SparkSession) -> Manifest | None:
        """The manifest of the last batch that ended."""
        found = [m for m in (self._stored(spark, slot) for slot in (0, 1)) if m is not None]
        return max(found, key=lambda m: m.batch_id, default=None)

    def load(self, spark: SparkSession, batch_id: int) -> Manifest:
        """What the batch before ``batch_id`` left.

        Batch 0 may repeat itself, but not begin over the folder of a stream that went further.
        """
        if batch_id == 0:
            for slot in (0, 1):
                other = self._stored(spark, slot)
                if other is not None and other.batch_id > 0:
                    raise RuntimeError(f"{self.root} holds batch {other.batch_id} of another run: use a new folder")
            return Manifest()
        found = self._stored(spark, batch_id - 1)
        if found is None or found.batch_id != batch_id - 1:
            raise RuntimeError(f"expected the state of batch {batch_id - 1}, found {found and found.batch_id}")
        return found

    def rows(self, spark: SparkSession, manifest: Manifest, wanted: Iterable[int] | None = None) -> DataFrame | None:
        """The rows of the wanted buckets (of all by default); only their folders are listed. None without any."""
        chosen = manifest.places if wanted is None else set(wanted) & set(manifest.places)
        if not chosen:
            return None
        paths = [self._folder(manifest.places[b], b) for b in sorted(chosen)]
        return spark.read.schema(T.StructType.fromJson(json.loads(manifest.schema))).parquet(*paths)

    def newest(self, spark: SparkSession) -> DataFrame | None:
        """The whole table as of the last batch."""
        found = self.last(spark)
        return None if found is None else self.rows(spark, found)

    def save(
        self, rows: DataFrame, before: Manifest, batch_id: int, latest: int | None, touched: Iterable[int], due: dict[int, int | None]
    ) -> None:
        """``rows`` are all rows of the ``touched`` buckets; ``due`` names those of them that have any, with their due times."""
        spark = rows.sparkSession
        self._clean(spark, before, batch_id)
        dealt = rows.withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET)
        dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(self._folder(batch_id))
        gone = set(touched)
        after = Manifest(
            batch_id,
            latest,
            rows.schema.json(),
            {b: n for b, n in before.places.items() if b not in gone} | dict.fromkeys(due, batch_id),
            {b: t for b, t in before.due.items() if b not in gone} | {b: t for b, t in due.items() if t is not None},
        )
        write_note(spark, self._manifest(batch_id), after.to_json())

    def _clean(self, spark: SparkSession, before: Manifest, batch_id: int) -> None:
        """Removes the buckets that the manifest to be replaced named and the one before this batch doesn't."""
        old = self._stored(spark, batch_id)
        if old is None or old.batch_id >= batch_id:
            return
        for bucket, place in old.places.items():
            if before.places.get(bucket) != place:
                drop_folder(spark, self._folder(place, bucket))


class Journal:
    """What the batches of a stream put out under one name, and the table that these outputs make.

    A batch writes its outputs first and the manifest of its state last. So that manifest is the one mark that makes
    all its outputs valid: rows of later batches, which failed or are being written, are not read.

    ``fold`` stores the table as a *snapshot*, after which reading opens the snapshot and the batches that came later. Marks of
    snapshots alternate between two slots; a snapshot stays until the one after the next is stored, for those who read it.
    The outputs themselves stay.
    """

    def __init__(self, state: BucketedState, kind: str) -> None:
        self.state = state
        self.folder = f"{state.root}/{kind}"

    def committed(self, spark: SparkSession) -> int:
        """The last batch that ended, -1 before the first."""
        last = self.state.last(spark)
        return -1 if last is None else last.batch_id

    def _marks(self, spark: SparkSession) -> list[dict | None]:
        """Batch and layout of the snapshot in each slot."""
        texts = [read_note(spark, f"{self.folder}-snapshot/mark-{slot}") for slot in (0, 1)]
        return [json.loads(text) if text else None for text in texts]

    def _rows_of(self, batch_id: int) -> str:
        return f"{self.folder}-snapshot/rows-{batch_id}"

    def read(self, spark: SparkSession, upto: int) -> tuple[DataFrame | None, DataFrame]:
        """(the newest snapshot, what the batches after it up to ``upto`` put out, with ``batch_id``)."""
        mark = max((m for m in self._marks(spark) if m), key=lambda m: m["batch_id"], default=None)
        base, first = None, 0
        if mark is not None:
            layout = T.StructType.fromJson(mark["schema"])
            base, first = spark.read.schema(layout).parquet(self._rows_of(mark["batch_id"])), mark["batch_id"] + 1
        later = [f"{self.folder}/batch_id={n}" for n in range(first, upto + 1)]
        log = spark.read.option("basePath", self.folder)
        if later:
            return base, log.parquet(*later)
        # No batch to read: any one tells the columns.
        return base, log.parquet(f"{self.folder}/batch_id={max(first - 1, 0)}").filter(F.lit(False))

    def fold(self, table: DataFrame, upto: int) -> None:
        """Store ``table``, made of all outputs up to batch ``upto``, as a snapshot."""
        spark = table.sparkSession
        marks = self._marks(spark)
        if any(m is not None and m["batch_id"] >= upto for m in marks):
            return
        slot = min((0, 1), key=lambda n: -1 if marks[n] is None else marks[n]["batch_id"])
        table.hint("rebalance").write.mode("overwrite").parquet(self._rows_of(upto))
        write_note(spark, f"{self.folder}-snapshot/mark-{slot}", json.dumps({"batch_id": upto, "schema": table.schema.jsonValue()}))
        if marks[slot] is not None:
            drop_folder(spark, self._rows_of(marks[slot]["batch_id"]))


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text stored by ``write_note``, None without one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    row = spark.read.schema("manifest STRING").parquet(path).first()
    return None if row is None else row["manifest"]


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A short text as a table of one row, replaced as a whole."""
    note = spark.range(1, numPartitions=1).select(F.lit(text).alias("manifest"))
    note.write.mode("overwrite").parquet(path)


def output(rows: DataFrame, root: str, kind: str, batch_id: int) -> None:
    """Rows of a batch below ``root``; rebalanced, so that they make files of a useful size. Replaces a repeated batch's own."""
    rows.hint("rebalance").write.mode("overwrite").parquet(f"{root}/{kind}/batch_id={batch_id}")
