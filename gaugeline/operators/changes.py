"""Insert, update and delete changes between two states of a keyed table, and their replay."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Operation codes of the change log.
INSERT = 1
UPDATE = 2
DELETE = -1

POINT_KEY = ("node_uri", "time", "abnormal_type")
RANGE_KEY = ("node_uri", "last_abnormal_time", "abnormal_type")


def change_log(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """What turns ``old`` into ``new``: ``op`` and the row (for a delete, the row that goes).

    Both are unique on ``key`` and have the same columns.
    """
    values = [c for c in new.columns if c not in key]
    before = old.select(*key, F.struct(F.lit(True).alias("here"), *values).alias("before"))
    after = new.select(*key, F.struct(F.lit(True).alias("here"), *values).alias("after"))
    op = (
        F.when(F.col("before").isNull(), INSERT)
        .when(F.col("after").isNull(), DELETE)
        .when(~F.col("before").eqNullSafe(F.col("after")), UPDATE)
    )
    row = F.coalesce("after", "before")
    return (
        before.join(after, list(key), "full_outer")
        .select(op.cast("int").alias("op"), *key, *[row[c].alias(c) for c in values])
        .filter("op IS NOT NULL")
    )


def row_change(there: Column, now: Column, same: Column) -> Column:
    """The operation that turns a row as it was into what it is, NULL for none; both states stand on one row."""
    there, now = F.coalesce(there, F.lit(False)), F.coalesce(now, F.lit(False))
    return F.when(now & ~there, INSERT).when(there & ~now, DELETE).when(now & there & ~same, UPDATE).cast("int")


def row_changes(
    rows: DataFrame, there: Column, now: Column, key: dict[str, Column], was: dict[str, Column], values: dict[str, Column]
) -> DataFrame:
    """A change log from rows that hold both states of themselves, without a join.

    ``there`` and ``now`` say whether the row is part of the old and the new table, ``was`` and ``values`` what it says in each.
    """
    same = reduce(and_, [values[c].eqNullSafe(was[c]) for c in values], F.lit(True))
    changed = rows.withColumn("op", row_change(there, now, same)).filter("op IS NOT NULL")
    shown = [F.when(F.col("op") == DELETE, was[c]).otherwise(values[c]).alias(c) for c in values]
    return changed.select("op", *[x.alias(c) for c, x in key.items()], *shown)


def apply_changes(
    base: DataFrame, log: DataFrame, key: Sequence[str], order: Sequence[str] | None = None
) -> DataFrame:
    """``base`` after the changes of each key, one after the other in ``order``.

    An insert of a present row does nothing, nor does an update or delete of an absent one. ``order`` is
    ``batch_id`` and, where the log has it, ``seq``; changes of one place in it count as delete, insert, update.
    Replaying a change, or a whole batch of them, changes nothing.

    No key's changes are gathered. What happens to a key follows from its last delete, the first insert after it,
    and its last update, if that comes later than both (or than the delete, where ``base`` holds the row).
    """
    order = order or [c for c in ("batch_id", "seq") if c in log.columns]
    columns = base.columns
    values = [c for c in columns if c not in key]
    op = F.col("op")
    rank = F.when(op == DELETE, 0).when(op == INSERT, 1).otherwise(2)
    moves = log.select(*key, "op", F.struct(*order, rank.alias("rank")).alias("at"), F.struct(*values).alias("row"))
    marks = moves.groupBy(*key).agg(
        F.max(F.when(op == DELETE, F.col("at"))).alias("gone"),
        F.max(F.when(op == UPDATE, F.col("at"))).alias("updated"),
        F.max_by("row", F.when(op == UPDATE, F.col("at"))).alias("update"),
    )
    after = F.col("gone").isNull() | (F.col("at") > F.col("gone"))
    inserts = moves.filter(op == INSERT).join(marks.select(*key, "gone"), list(key)).filter(after)
    inserts = inserts.groupBy(*key).agg(F.min("at").alias("inserted"), F.min_by("row", "at").alias("insert"))
    present = base.select(*key, F.struct(F.lit(True).alias("here"), *values).alias("now"))
    known = marks.join(inserts, list(key), "left")
    both = present.join(known, list(key), "full_outer")
    stays = F.col("now.here").isNotNull() & F.col("gone").isNull()
    since = F.when(stays, F.lit(None)).otherwise(F.col("inserted"))
    newer = F.col("updated").isNotNull() & (F.col("gone").isNull() | (F.col("updated") > F.col("gone")))
    holds = newer & (stays | (F.col("updated") > since))
    held = {c: F.when(holds, F.col(f"update.{c}")).when(stays, F.col(f"now.{c}")).otherwise(F.col(f"insert.{c}")) for c in values}
    return both.filter(stays | F.col("inserted").isNotNull()).select(
        *[F.col(c) if c in key else held[c].alias(c) for c in columns]
    )
