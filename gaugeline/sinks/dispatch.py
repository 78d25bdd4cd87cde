"""Choosing a sink by name."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from gaugeline.sinks import jdbc, keyed_table
from gaugeline.sinks.keyed_json import keyed_json, write_topic
from gaugeline.sinks.once import once_per_batch


def trigger(writer: DataStreamWriter, every: str | None = None, drain: bool = False) -> DataStreamWriter:
    """As fast as possible, ``every`` so often, or ``drain`` what is there and stop."""
    if drain:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every) if every else writer


def write_stream(
    df: DataFrame,
    kind: str,
    checkpoint: str | None = None,
    mode: str = "append",
    every: str | None = None,
    drain: bool = False,
    **options: Any,
) -> StreamingQuery:
    """Start ``df`` into the sink ``kind``:

    ``mysql`` or ``jdbc`` (``url``, ``table`` and writer options), ``kafka`` (readings as keyed JSON;
    ``format`` and ``path`` replace the broker), ``hbase`` or ``keyed`` (``path``, ``regions``; rows of
    ``uri, v, t``), ``keyed_year``, ``console``, ``foreach`` (``writer``), ``foreach_batch`` (``write``).
    ``ledger`` makes ``jdbc`` and ``kafka`` skip batches that were written before.
    """
    out = df.writeStream.outputMode(mode)
    if checkpoint:
        out = out.option("checkpointLocation", checkpoint)
    out = trigger(out, every, drain)
    ledger = options.pop("ledger", None)

    if kind == "console":
        return out.format("console").options(**options).start()
    if kind == "foreach":
        return out.foreach(options["writer"]).start()
    if kind == "foreach_batch":
        write = options["write"]
    elif kind == "kafka":
        form = options.pop("format", "kafka")

        def write(batch: DataFrame, batch_id: int) -> None:
            write_topic(keyed_json(batch), form, **options)

    elif kind in ("hbase", "keyed", "keyed_year"):
        place = keyed_table.put_by_year if kind == "keyed_year" else keyed_table.put
        path, regions = options["path"], options.get("regions", 100)

        def write(batch: DataFrame, batch_id: int) -> None:
            place(keyed_table.with_row_key(batch, regions), path, batch_id)

    else:
        url, table = options.pop("url"), options.pop("table")
        columns = options.pop("columns", None)

        def write(batch: DataFrame, batch_id: int) -> None:
            jdbc.append(jdbc.layout(batch, columns) if columns else batch, url, table, **options)

    return out.foreachBatch(once_per_batch(write, ledger) if ledger else write).start()
