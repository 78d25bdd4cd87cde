"""Running values per point and window, with a due time for each: a silent point's window is closed all the same.

Every micro-batch gives the windows it touches as they stand (update mode). A window is closed once the watermark, the
latest event time less the delay, has passed its end; then its row comes once more, marked, and its state goes. No
reading of the point is needed for that: open windows are a table in buckets of points, each bucket knows the
earliest end in it, and a batch visits the buckets it has readings for and those that are due.

Readings shrink to one row per point and window before they meet the state, by an aggregate that combines before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.times import floor_to
from gaugeline.streaming.state import BUCKET, BucketedState, Journal, output


class RunningWindows:
    """Use as ``foreachBatch``. Batches hold ``id, t, v`` and ``order``, the readings' order of arrival (decimal or whole numbers).

    Rows go to ``windows/batch_id=N`` below ``root``: ``id, window_start, sum_v, n, avg_v, last_v, closed``. ``last_v`` is the
    value at the latest time, of equal times the one that arrived last. All readings count, repeated ones too. A reading whose
    window the watermark passed before its batch goes to ``late/batch_id=N``, readings without id, time or value are left out.
    """

    def __init__(
        self,
        root: str,
        delay_ms: int,
        length_ms: int = 60_000,
        order: str = "seq",
        buckets: int = 64,
        on_rows: Callable[[DataFrame, int], None] | None = None,
    ) -> None:
        self.root = root.rstrip("/")
        self.open = BucketedState(root, "open", buckets)
        self.delay_ms = delay_ms
        self.length_ms = length_ms
        self.order = order
        self.on_rows = on_rows

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self.open.load(spark, batch_id)
        start = floor_to(F.col("t"), self.length_ms)
        batch = batch.filter("id IS NOT NULL AND t IS NOT NULL AND v IS NOT NULL").withColumn("window_start", start)
        end = F.col("window_start") + self.length_ms
        passed = None if before.latest is None else before.latest - self.delay_ms
        late = F.coalesce(end <= F.lit(passed), F.lit(False))
        seen, n_late, buckets = batch.agg(
            F.max("t"), F.count(F.when(late, 1)), F.collect_set(F.when(~late, self.open.bucket()))
        ).first()
        times = [x for x in (before.latest, seen) if x is not None]
        latest = max(times) if times else None
        watermark = None if latest is None else latest - self.delay_ms
        if n_late:
            output(batch.filter(late).select("id", "t", "v"), self.root, "late", batch_id)
        due = [b for b, t in before.due.items() if watermark is not None and t <= watermark]
        touched = sorted({*buckets, *due})

        place = F.struct("t", F.col(self.order).cast("decimal(38,0)").alias("seq"))
        keys = ("id", "window_start")
        parts = batch.filter(~late).groupBy(*keys).agg(
            F.sum("v").alias("sum_v"),
            F.count("v").alias("n"),
            F.max_by("v", place).alias("last_v"),
            F.max(place).alias("last_at"),
        )
        parts = parts.withColumn("is_new", F.lit(True))
        known = self.open.rows(spark, before, touched)
        if known is not None:
            parts = known.withColumn("is_new", F.lit(False)).unionByName(parts)
        windows = parts.groupBy(*keys).agg(
            F.sum("sum_v").alias("sum_v"),
            F.sum("n").alias("n"),
            F.max_by("last_v", "last_at").alias("last_v"),
            F.max("last_at").alias("last_at"),
            F.max("is_new").alias("is_new"),
        )
        closed = F.coalesce(end <= F.lit(watermark), F.lit(False))
        windows = windows.withColumn("closed", closed).persist()
        rows = windows.filter("is_new OR closed").select(
            *keys, "sum_v", "n", (F.col("sum_v") / F.col("n")).alias("avg_v"), "last_v", "closed"
        )
        output(rows, self.root, "windows", batch_id)
        if self.on_rows is not None:
            self.on_rows(rows, batch_id)
        still = windows.filter("NOT closed").select(*keys, "sum_v", "n", "last_v", "last_at")
        found = still.groupBy(self.open.bucket().alias(BUCKET)).agg(F.min(end)).collect()
        self.open.save(still, before, batch_id, latest, touched, {b: t for b, t in found})
        windows.unpersist()

    def state(self, spark: SparkSession) -> DataFrame | None:
        """The open windows as of the last batch."""
        return self.open.newest(spark)

    def table(self, spark: SparkSession) -> DataFrame:
        """Every window as of the last batch that ended."""
        return self._table(spark, Journal(self.open, "windows").committed(spark))

    def _table(self, spark: SparkSession, upto: int) -> DataFrame:
        base, rows = Journal(self.open, "windows").read(spark, upto)
        if base is not None:
            rows = base.withColumn("batch_id", F.lit(-1)).unionByName(rows)
        values = ("sum_v", "n", "avg_v", "last_v", "closed")
        return rows.groupBy("id", "window_start").agg(*[F.max_by(c, "batch_id").alias(c) for c in values])

    def snapshot(self, spark: SparkSession) -> None:
        """Store the table as of the last batch that ended; called by the owner of the stream now and then."""
        journal = Journal(self.open, "windows")
        upto = journal.committed(spark)
        if upto >= 0:
            journal.fold(self._table(spark, upto), upto)
