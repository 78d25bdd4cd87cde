"""JDBC tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from itertools import islice
from typing import Any

from pyspark.sql import DataFrame, DataFrameWriter, Row

from gaugeline.operators.changes import DELETE, INSERT, UPDATE

COMMIT_SIZE = 1000  # fixed value: statements per commit


def _writer(df: DataFrame, url: str, table: str, **options: str) -> DataFrameWriter:
    settings = {"batchsize": str(COMMIT_SIZE), **options, "url": url, "dbtable": table}
    return df.write.format("jdbc").options(**settings)


def append(df: DataFrame, url: str, table: str, **options: str) -> None:
    _writer(df, url, table, **options).mode("append").save()


def overwrite(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Replace the rows and keep the table's definition."""
    _writer(df, url, table, truncate="true", **options).mode("overwrite").save()


def layout(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Projection to a target layout: target name -> source column, in order."""
    return df.selectExpr(*[f"`{source}` AS `{target}`" for target, source in columns.items()])


def append_rows(df: DataFrame, columns: dict[str, str], url: str, table: str, **options: str) -> None:
    append(layout(df, columns), url, table, **options)


def statements(
    table: str, key: Sequence[str], values: Sequence[str], mark: str = "?"
) -> dict[int, tuple[str, list[str]]]:
    """Per operation the statement and the columns that fill its parameters, written as ``mark``."""
    columns = [*key, *values]
    at_key = " AND ".join(f"{c} = {mark}" for c in key)
    marks = ", ".join(mark for _ in columns)
    return {
        INSERT: (
            f"INSERT INTO {table} ({', '.join(columns)}) VALUES ({marks}) "
            f"ON CONFLICT ({', '.join(key)}) DO NOTHING",
            columns,
        ),
        UPDATE: (
            f"UPDATE {table} SET {', '.join(f'{c} = {mark}' for c in values)} WHERE {at_key}",
            [*values, *key],
        ),
        DELETE: (f"DELETE FROM {table} WHERE {at_key}", list(key)),
    }


def apply_changes(
    changes: DataFrame,
    connect: Callable[[], Any],
    table: str,
    key: Sequence[str],
    commit_size: int = COMMIT_SIZE,
    mark: str = "?",
) -> None:
    """Run a change log (one change per key) against a database, a statement per operation and commit.

    ``connect`` opens a DB-API connection on the executor, one per partition. Every statement
    is safe to repeat, so a retried task or batch does no harm.
    """
    values = [c for c in changes.columns if c not in (*key, "op", "batch_id")]
    plan = statements(table, key, values, mark)

    def write(rows: Iterable[Row]) -> None:
        rows, connection = iter(rows), None
        try:
            # Changes of a commit touch different keys, so those of one operation go together.
            while batch := list(islice(rows, commit_size)):
                connection = connection or connect()
                for op, (text, columns) in plan.items():
                    if own := [[row[c] for c in columns] for row in batch if row["op"] == op]:
                        connection.cursor().executemany(text, own)
                connection.commit()
        except Exception:
            if connection is not None:
                connection.rollback()
            raise
        finally:
            if connection is not None:
                connection.close()

    changes.foreachPartition(write)
