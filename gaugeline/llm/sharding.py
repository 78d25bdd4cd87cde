"""Sharding by balanced label propagation: linked documents share shards, shards have equally many rows.

Documents are linked through hubs: their whole text, and each line of some length. Label propagation runs between
documents and hubs as joins: a hub takes the shard most of its documents are in, a document wants the shard that most of its hubs
(by weight) have taken. Who may move is decided by quotas per pair of shards: a shard takes in
only as many documents as leave it, or as it has documents without any link to give in exchange. So the numbers of rows
stay exactly as even as they were at the start, at most one apart.

A hub larger than half a shard is split by hash of the row into parts that fit in a shard, which also keeps its
joins even. Everything is DataFrame functions; the driver sees counts per pair of shards only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import running, written

SHARDS = 24
ROUNDS = 3
# Shortest line that links documents, in characters, and what an equal text weighs against an equal line.
LINE = 40
TEXT_WEIGHT = 8


def _hubs(text: Column) -> Column:
    """``hub, weight`` of a text: itself and its lines; an empty text has none."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(line) >= LINE)
    whole = F.struct(F.xxhash64(F.lit("text"), text).alias("hub"), F.lit(TEXT_WEIGHT).alias("weight"))
    each = F.transform(
        F.array_distinct(F.transform(lines, lambda line: F.xxhash64(F.lit("line"), line))),
        lambda hub: F.struct(hub.alias("hub"), F.lit(1).alias("weight")),
    )
    return F.when(text != "", F.concat(F.array(whole), each))


def _links(narrow: DataFrame, rows: int, shards: int) -> DataFrame:
    """``row, hub, weight`` of hubs with two rows at least; large hubs in parts."""
    held = narrow.select("row", F.inline("hubs"))
    half = max(rows // (2 * shards), 1)
    sizes = held.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = sizes.select("hub", F.ceil(F.col("n") / half).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("row"), F.col("parts"))
    hub = F.when(F.col("parts") > 1, F.xxhash64("hub", part)).otherwise(F.col("hub"))
    return held.join(sizes, "hub").select("row", hub.alias("hub"), "weight")


def _quotas(wanted: list[list[int]], free: list[int]) -> list[list[int]]:
    """Moves allowed from shard to shard, so that none gains more rows than it has free ones to give."""
    n = len(free)
    quota = [list(row) for row in wanted]
    while True:
        over = None
        for b in range(n):
            net = sum(quota[a][b] for a in range(n)) - sum(quota[b])
            if net > free[b]:
                over = (b, net - free[b])
                break
        if over is None:
            return quota
        b, excess = over
        for a in sorted(range(n), key=lambda a: -quota[a][b]):
            cut = min(quota[a][b], excess)
            quota[a][b] -= cut
            excess -= cut


def _lookup(values: list[int], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), at.cast("int") + 1)


def _seen(rows: list, n: int) -> list[list[int]]:
    table = [[0] * n for _ in range(n)]
    for a, b, count in rows:
        table[a][b] = count
    return table


def shard(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, rounds: int = ROUNDS
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, shard, slot``.

    ``size`` is the text's UTF-8 bytes plus 8; numbers of rows per shard are at most one apart. ``slot`` counts
    the rows of a shard from 0 without a gap. Null texts count as empty; empty texts are linked with
    nothing. Rows that share an id are rows of their own. An empty table gives none; extra columns are not looked at.
    """
    raw = F.coalesce(F.col(text).cast("string"), F.lit(""))
    table = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), raw.alias("text"))
    # The rows without their texts, in order of text: equal texts start next to each other.
    narrow = table.select(
        "row",
        "doc_id",
        (F.octet_length("text") + 8).cast("bigint").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit("text"), F.col("text")).alias("whole"),
        _hubs(F.col("text")).alias("hubs"),
    )
    narrow = written(narrow, "documents")
    rows = narrow.count()
    placed = running(narrow.select("row", "whole"), [], ["whole", "row"], F.lit(1), "place")
    start = F.floor(F.col("place") * shards / max(rows, 1)).cast("int")
    start = F.least(start, F.lit(shards - 1)).alias("shard")

    links = written(_links(narrow, rows, shards), "links")
    linked = links.select("row").distinct().withColumn("linked", F.lit(True))
    first = written(placed.select("row", start).join(linked, "row", "left"), "start")
    label = first.filter("linked").select("row", "shard")
    free = running(first.filter("linked IS NULL").select("row", "shard"), ["shard"], ["row"], F.lit(1), "nth")
    free = written(free.select("row", "shard", "nth"), "free")
    given = [0] * shards
    left = [0] * shards
    for s, n in free.groupBy("shard").count().collect():  # a row per shard
        left[s] = n
    moved_free = F.col("shard")

    for _ in range(rounds):
        seen = links.join(label, "row").groupBy("hub", "shard").agg(F.count(F.lit(1)).alias("n"))
        taken = seen.groupBy("hub").agg(F.max_by("shard", F.struct("n", F.xxhash64("hub", "shard"))).alias("want"))
        votes = links.join(taken, "hub").groupBy("row", "want").agg(F.sum("weight").alias("votes"))
        wish = votes.join(label, "row").groupBy("row", "shard").agg(
            F.max_by("want", F.struct("votes", F.xxhash64("row", "want"))).alias("want"),
            F.max("votes").alias("most"),
            F.coalesce(F.max(F.when(F.col("want") == F.col("shard"), F.col("votes"))), F.lit(0)).alias("now"),
        )
        movers = wish.filter("want <> shard AND most > now").select("row", "shard", "want", (F.col("now") - F.col("most")).alias("loss"))
        ranked = running(movers, ["shard", "want"], ["loss", F.xxhash64("row"), "row"], F.lit(1), "nth")
        ranked = written(ranked.select("row", "shard", "want", "nth"), "movers")
        flows = ranked.groupBy("shard", "want").count().collect()  # a row per pair of shards
        quota = _quotas(_seen(flows, shards), left)
        allowed = _lookup([q for line in quota for q in line], F.col("shard") * shards + F.col("want"))
        accepted = ranked.filter(F.col("nth") < allowed).select("row", F.col("want").alias("to"))
        label = label.join(accepted, "row", "left").select("row", F.coalesce("to", "shard").alias("shard"))
        label = written(label, "labels")
        # Free rows go from shards that gained rows to those that lost some.
        net = [sum(quota[a][b] for a in range(shards)) - sum(quota[b]) for b in range(shards)]
        short = [[b, -n] for b, n in enumerate(net) if n < 0]
        for b, surplus in enumerate(net):
            while surplus > 0:
                to, lack = short[-1]
                n = min(surplus, lack)
                inside = (F.col("shard") == b) & (F.col("nth") >= given[b]) & (F.col("nth") < given[b] + n)
                moved_free = F.when(inside, F.lit(to)).otherwise(moved_free)
                given[b] += n
                left[b] -= n
                surplus -= n
                short[-1][1] -= n
                if not short[-1][1]:
                    short.pop()

    final = label.union(free.select("row", moved_free.cast("int").alias("shard")))
    final = narrow.select("row", "doc_id", "size", "text_crc32").join(final, "row")
    return running(final, ["shard"], ["row"], F.lit(1), "slot").drop("row")

