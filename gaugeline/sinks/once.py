"""Writing every micro-batch at most once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BatchSink = Callable[[DataFrame, int], None]


def last_committed(spark: SparkSession, ledger: str) -> int:
    """The highest batch in the ledger, -1 before the first."""
    try:
        done = spark.read.schema("batch_id BIGINT").option("recursiveFileLookup", True).parquet(ledger)
    except AnalysisException:  # nothing was committed yet
        return -1
    newest = done.agg(F.max("batch_id")).first()[0]
    return -1 if newest is None else newest


def committed(spark: SparkSession, ledger: str, batch_id: int) -> bool:
    return batch_id <= last_committed(spark, ledger)


def once_per_batch(write: BatchSink, ledger: str) -> BatchSink:
    """``write`` guarded by a ledger folder, which outlives a restart of the query.

    A query's batches come in order, so the ledger is the id of the last one: two slots take turns, and while
    one is replaced the other still names the batch before.

    For sinks that append. A failure between the write and the entry repeats the batch; only a sink
    that replaces by batch id (``keyed_table.put``, ``IncrementalRuns``) closes that gap.
    """

    def guarded(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if committed(spark, ledger, batch_id):
            return
        write(batch, batch_id)
        entry = spark.range(1, numPartitions=1).select(F.lit(batch_id).cast("bigint").alias("batch_id"))
        entry.write.mode("overwrite").parquet(f"{ledger}/slot-{batch_id % 2}")

    return guarded
