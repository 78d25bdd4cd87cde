"""A writer that is handed single rows, for stores that only have a client."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyarrow import fs
from pyspark.sql import Row


class RowWriter:
    """For ``writeStream.foreach``: puts rows in groups through a client opened per partition.

    ``connect()`` gives the client, ``put(client, rows)`` stores a list of rows. With ``per_epoch`` it is
    ``connect(partition_id, epoch_id)``, by which a client can tell a repeated epoch and replace what it stored before. Prefer
    the other sinks where there is one: they do not leave the JVM.
    """

    def __init__(
        self,
        connect: Callable[..., Any],
        put: Callable[[Any, list[Row]], None],
        group: int = 1000,
        per_epoch: bool = False,
    ) -> None:
        self.connect = connect
        self.put = put
        self.group = group
        self.per_epoch = per_epoch

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.client = self.connect(partition_id, epoch_id) if self.per_epoch else self.connect()
        self.rows: list[Row] = []
        return True

    def process(self, row: Row) -> None:
        self.rows.append(row)
        if len(self.rows) >= self.group:
            self._flush()

    def _flush(self) -> None:
        if self.rows:
            self.put(self.client, self.rows)
            self.rows = []

    def close(self, error: Exception | None) -> None:
        if getattr(self, "client", None) is None:
            return
        if error is None:
            self._flush()
        close = getattr(self.client, "close", None)
        if close is not None:
            close()


class LinesClient:
    """Rows as lines of JSON, a file per epoch and partition below ``path``, which all executors reach.

    A repeated epoch replaces its files, so every row is stored once, provided that the epoch is dealt to as many partitions as
    before; a run that changes this takes a new folder.
    """

    def __init__(self, path: str, partition_id: int, epoch_id: int) -> None:
        system, folder = fs.FileSystem.from_uri(path)
        system.create_dir(f"{folder}/epoch={epoch_id}", recursive=True)
        self.file = system.open_output_stream(f"{folder}/epoch={epoch_id}/part-{partition_id}.json")

    def put(self, rows: list[Row]) -> None:
        lines = [json.dumps(row.asDict(recursive=True), default=str) for row in rows]
        self.file.write("".join(f"{line}\n" for line in lines).encode())

    def close(self) -> None:
        self.file.close()


def lines_writer(path: str, group: int = 1000) -> RowWriter:
    """A ``RowWriter`` into files of lines."""
    return RowWriter(lambda part, epoch: LinesClient(path, part, epoch), LinesClient.put, group, per_epoch=True)
