"""Exact deduplication by naming: equal texts get equal integers, unequal texts never do.

A text is cut into blocks of a fixed number of characters. The distinct blocks are sorted and each
gets an integer, its name. Adjacent names of a document are then paired, the distinct pairs are sorted
and named in turn, and so on until one name is left per document: its identity. No digest decides
equality, names come from sorting whole blocks.

Everything is DataFrame functions. Block texts are shuffled once, after copies within a task collapsed; the names
go back to the documents by a digest of the block, and the job stops with an error should two different
blocks ever share one. A document that holds a block (or pair) no other row holds equals no
other row, so it leaves the naming at once; what is left are about as many rows as there are copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import SPACE, fresh, matching, numbered, written

BLOCK = 1024


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), f"[{SPACE}]+", " ")


def _blocks(text: Column, block: int) -> Column:
    """Blocks of ``block`` characters in one pass over the text; an empty text is one empty block."""
    return F.when(text == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}"), F.lit(0)))


def _digest(block: Column) -> Column:
    return F.unhex(F.sha2(block, 256))


def _named(values: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct ``keys`` with the number of rows of each and an integer in sorted order."""
    counted = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("held"))
    return counted.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def exact_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str | None = None, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``docs``: ``row, doc_id, keep_id, group_size, kept, text_sha256``.

    ``row`` names a column of unique integers; without it rows are numbered here.

    ``keep_id`` is the smallest id of the rows with the same text, null only if all of them are null;
    ``kept`` is true for one row of a group (rows with the same text and id are alike, one of them stays).
    Null texts count as empty. Empty tables give none; extra columns are not looked at, so
    their names don't matter.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    source = docs.select(number.alias("row"), F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("text"))
    cut = source.withColumn("blocks", _blocks(F.col("text"), block))
    rows = written(
        cut.select(
            "row",
            "doc_id",
            F.sha2("text", 256).alias("text_sha256"),
            F.transform("blocks", _digest).alias("digests"),
        ),
        "dedup-rows",
    )

    # Level 0: the whole blocks.
    # Outer, though no text is without a block: else the blocks are made twice, once to filter empty ones.
    texts = cut.select(F.explode_outer("blocks").alias("block"))
    names = _named(texts, ["block"]).select(_digest(F.col("block")).alias("digest"), "held", "name")
    names = written(names, "block-names")
    twice = names.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if twice.limit(1).count():
        raise RuntimeError("two different blocks share a SHA-256 digest")
    held = rows.select("row", F.posexplode("digests").alias("at", "digest"))
    named = held.join(names, "digest").select("row", "at", "name", "held")

    # A document all of whose blocks are held elsewhere goes on; the rest are known to be single.
    done = []
    level = 0
    while True:
        named = written(named, "names")
        state = named.groupBy("row").agg(F.max("at").alias("last"), F.min("held").alias("least"))
        shared = state.filter("least > 1")
        ended = shared.filter("last = 0").select("row")
        # Identities of different levels differ in length, so the level is a part of them.
        done.append(named.join(ended, "row", "left_semi").select("row", F.lit(level).alias("level"), "name"))
        going = written(named.join(shared.filter("last > 0"), "row", "left_semi").select("row", "at", "name"), "names")
        if going.isEmpty():
            break
        half = F.floor(F.col("at") / 2).cast("int")
        pairs = going.groupBy("row", half.alias("at")).agg(
            F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"),
        )
        pairs = written(pairs, "pairs")
        named = pairs.join(_named(pairs, ["left", "right"]), ["left", "right"]).select("row", "at", "name", "held")
        level += 1

    identities = done[0]
    for more in done[1:]:
        identities = identities.union(more)
    # Rows of one identity: first per id, so that a group of copies shrinks before the shuffle.
    members = identities.join(rows.select("row", "doc_id"), "row")
    members = written(members, "identities")
    groups = members.groupBy("level", "name").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"),
        F.count(F.lit(1)).alias("size"),
    )
    found = members.join(groups, ["level", "name"]).select(
        "row", F.col("first.doc_id").alias("keep"), F.col("first.row").alias("keep_row"), "size"
    )
    out = rows.drop("digests").join(found, "row", "left")
    alone = F.col("size").isNull()
    return out.select(
        "row",
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("keep_row") == F.col("row"))).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """``docs`` without the rows that repeat another row's text; the smallest id stays. Same columns."""
    row = fresh(docs, "row_number")
    table = numbered(docs, row)
    groups = exact_groups(table, doc_id, text, row, block)
    gone = written(groups.filter("NOT kept").select(F.col("row").alias(row)), "dropped")
    return matching(table, gone, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
