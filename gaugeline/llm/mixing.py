"""Mixing sources to target weights: each source gives an exact number of words.

Every row gets a hash-random key. Rows are range-sorted by key within their source, running
totals of the sizes are taken across the ranges, and a source is cut where its budget ends. A source
whose budget exceeds its size is taken whole as often as it fits, and the rest is cut from the next pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import SPACE, fresh, numbered, running, written

WEIGHTS = (1, 2, 3)
EPOCHS = 3


def words(text: Column) -> Column:
    """Number of runs without white space; null has none."""
    count = F.regexp_count(text.cast("string"), F.lit(f"[^{SPACE}]+"))
    return F.coalesce(count, F.lit(0)).cast("bigint")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``source, source_size`` with ``weight`` and ``target``.

    All sizes together are shared by weight; a target stops at ``epochs`` times its source's size and the
    excess is shared among the others by weight, until none is above. The table has a row per source; only sums
    over it come to the driver, in as many rounds as sharing takes.
    """
    # Place in the order of the sources, null last; by running totals, as there may be millions of sources.
    ranked = running(sources, [], [F.col("source").isNull(), F.col("source")], F.lit(1), "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights)).cast("int") + 1)
    table = written(
        ranked.select("source", "source_size", weight.cast("bigint").alias("weight"), (F.col("source_size") * epochs).alias("cap")),
        "sources",
    )
    total = table.agg(F.sum("source_size")).first()[0] or 0
    share, of = total, table.agg(F.sum("weight")).first()[0] or 0
    while True:
        # Full: its cap is below its share, share / of * weight. Whole numbers, so nothing is rounded.
        full = F.col("cap") * F.lit(of).cast("decimal(20,0)") < F.lit(share).cast("decimal(20,0)") * F.col("weight")
        caps, left = table.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))
        ).first()
        if (total - caps, left) == (share, of):
            break
        share, of = total - caps, left
    shared = (F.col("weight") * F.lit(share).cast("bigint")).cast("double") / F.lit(float(max(of, 1)))
    return table.select("source", "source_size", "weight", F.when(full, F.col("cap").cast("double")).otherwise(shared).alias("target"))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    epochs: int = EPOCHS,
    row: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``row, doc_id, source, size, source_size, target, taken``.

    ``row`` names a column of unique integers; without it rows are numbered here.

    ``taken`` counts the words the mix takes of the row, repeats included: whole passes, plus the part of the last
    pass before the cut. Every source gives ``floor(target + 1/2)`` words exactly. Null texts have no words, null
    sources are a source of their own, the last; rows that share an id are ordered by their size, and
    rows alike in both are interchangeable. Extra columns are not looked at.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    narrow = docs.select(number.alias("row"), F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), words(F.col(text)).alias("size"))
    narrow = written(narrow, "sizes")
    per_source = targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, epochs)
    per_source = written(per_source, "targets")
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    placed = running(narrow, ["source"], [key, F.col("doc_id"), F.col("size"), F.col("row")], F.col("size"), "start")
    out = placed.join(per_source.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    budget = F.floor(F.col("target") + F.lit(0.5)).cast("bigint")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    rest = budget - whole * F.col("source_size")
    part = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), rest - F.col("start")))
    return out.select("row", "doc_id", "source", "size", "source_size", "target", (whole * F.col("size") + part).alias("taken"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each row as often as it is taken whole, and once more for a rest.

    The row at which a source's budget ends is cut after its last word taken; a row of no words is taken as often as
    its source is begun.
    """
    row, n, whole_of, rest_of = (fresh(docs, name) for name in ("row_number", "copy_number", "whole_copies", "rest_words"))
    table = numbered(docs, row)
    taken = mix(table, doc_id, text, source, row=row, **how)
    begun = F.ceil(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(F.greatest(begun, F.lit(1)))
    rest = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0)
    plan = taken.select(F.col("row").alias(row), whole.cast("int").alias(whole_of), rest.alias(rest_of))
    copies = F.col(whole_of) + F.when(F.col(rest_of) > 0, 1).otherwise(0)
    out = table.join(plan, row).filter(copies > 0).withColumn(n, F.explode(F.sequence(F.lit(1), copies)))
    kept = F.slice(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"[{SPACE}]*[^{SPACE}]+"), 0), 1, F.col(rest_of).cast("int"))
    cut = F.when(F.col(n) > F.col(whole_of), F.array_join(kept, "")).otherwise(F.col(f"`{text}`"))
    return out.select(*[cut.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
