"""Near duplicates by weighted Jaccard similarity: BagMinHash signatures, bands, verified overlap.

A document is the bag of its five-word shingles; the weight of a shingle is how often it occurs. Weights are levels
0, 1, 2, ..., and each shingle has Poisson processes over doubling ranges of levels ([0,1), [1,2), [2,4), ...).
Points come in order of time; a point belongs to one level of its range and counts if the weight covers
that level. Each point falls on one register, which keeps its earliest point. Two registers agree with the
probability of the weighted Jaccard similarity, and points later than a document's latest register
are never made.

Copies (equal bags) become one representative before anything is paired. Representatives that share a
band are candidates. Instead of all pairs of a bucket, each member is first checked against one member of
each of its buckets, the one that shares buckets with most others. Only what then still lies in different
components and shares a bucket is checked pair by pair, inside tasks of bounded size that emit links
alone. Every link is verified on whole bags, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import components, forget, fresh, matching, numbered, parts_for, written
from gaugeline.llm.shingles import held, mix64, shingles, slices, word_hashes

WORDS = 5
SIMILAR = 0.8
# At similarity 0.8 a pair shares a band with probability 1 - (1 - 0.8**6)**32 > 0.9999.
BANDS, ROWS = 32, 6
# Members of a block of a large bucket.
TILE = 512


def _weighted(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with weights, sorted."""
    value, text, _ = shingles(word_hashes(texts), n)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.flatnonzero(np.append(True, (value[1:] != value[:-1]) | (text[1:] != text[:-1]))[: len(value)])
    weight = np.diff(np.append(new, len(value)))
    return value[new], text[new], weight


def signatures(value: np.ndarray, text: np.ndarray, weight: np.ndarray, texts: int, size: int) -> np.ndarray:
    """``texts x size`` registers: times of the earliest points. Texts without shingles keep infinity."""
    register = np.full((texts, size), np.inf)
    # Ranges of levels: number 0 is [0, 1), number j is [2**(j-1), 2**j). Those that begin below the weight count.
    units = [(value, text, weight, np.zeros(len(value), np.int64))]
    for j in range(1, int(weight.max(initial=0)).bit_length() + 1):
        more = weight > (1 << (j - 1))
        units.append((value[more], text[more], weight[more], np.full(int(more.sum()), j)))
    value, text, weight, number = (np.concatenate(x) for x in zip(*units, strict=True))
    low = np.where(number > 0, np.left_shift(1, np.maximum(number - 1, 0)), 0)
    rate = np.maximum(low, 1)
    seed = mix64(value ^ mix64(number.astype(np.uint64) + np.uint64(7)))
    time = np.zeros(len(value))
    k = 0
    while len(value):
        draw = mix64(seed + np.uint64(k))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / rate
        other = mix64(draw)
        level = low + ((other >> np.uint64(32)) % rate.astype(np.uint64)).astype(np.int64)
        hit = level < weight
        slot = (other & np.uint64(0xFFFFFFFF)) % np.uint64(size)
        np.minimum.at(register.reshape(-1), text[hit] * size + slot[hit].astype(np.int64), time[hit])
        on = time < register.max(1)[text]
        value, text, weight, low, rate, seed, time = (x[on] for x in (value, text, weight, low, rate, seed, time))
        k += 1
    return register


def _bands(register: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = register.view(np.uint64).reshape(len(register), bands, rows)
    value = np.zeros(parts.shape[:2], np.uint64) + np.arange(bands, dtype=np.uint64)
    for i in range(rows):
        value = mix64(value * np.uint64(0xD1342543DE82EF95) + parts[:, :, i])
    return value.view(np.int64)


def sketches(table: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """``row, size, key1, key2, bands``: number of shingles, a key of the whole bag, and its bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in held(batches):
            for begin, own in slices(batch.column("text").to_pylist()):
                value, text, weight = _weighted(own, n)
                register = signatures(value, text, weight, len(own), bands * rows)
                keys = []
                for salt in (1, 2):
                    part = mix64(mix64(value + np.uint64(salt)) * weight.astype(np.uint64) + np.uint64(salt))
                    total = np.zeros(len(own), np.uint64)
                    np.add.at(total, text, part)
                    keys.append(total.view(np.int64))
                size = np.bincount(text, weight, len(own)).astype(np.int64)
                values = pa.array(_bands(register, bands, rows).reshape(-1))
                yield pa.record_batch(
                    {
                        "row": batch.column("row").slice(begin, len(own)),
                        "size": pa.array(size),
                        "key1": pa.array(keys[0]),
                        "key2": pa.array(keys[1]),
                        "bands": pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * bands), values),
                    }
                )

    return table.select("row", "text").mapInArrow(run, "row bigint, size bigint, key1 bigint, key2 bigint, bands array<bigint>")


def bags(table: DataFrame, n: int) -> DataFrame:
    """``row, bag``: sorted 64-bit hashes of (shingle, how many times before), eight bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in held(batches):
            for begin, own in slices(batch.column("text").to_pylist()):
                value, text, weight = _weighted(own, n)
                nth = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
                item = mix64(np.repeat(value, weight) + mix64(nth.astype(np.uint64)))
                text = np.repeat(text, weight)
                order = np.lexsort((item, text))
                edges = np.searchsorted(text[order], np.arange(len(own) + 1))
                item = item[order]
                raw = [item[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]
                yield pa.record_batch({"row": batch.column("row").slice(begin, len(own)), "bag": pa.array(raw, pa.binary())})

    return table.select("row", "text").mapInArrow(run, "row bigint, bag binary")


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared, either = [], []
        for x, y in zip(batch.column("bag_a"), batch.column("bag_b"), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            same = len(np.intersect1d(x, y, assume_unique=True))
            shared.append(same)
            either.append(len(x) + len(y) - same)
        yield pa.record_batch(
            {"a": batch.column("a"), "b": batch.column("b"), "shared": pa.array(shared, pa.int64()), "either": pa.array(either, pa.int64())}
        )


def verified(pairs: DataFrame, bag: DataFrame, similar: float) -> DataFrame:
    """The pairs ``a, b`` whose bags overlap enough."""
    left = bag.select(F.col("row").alias("a"), F.col("bag").alias("bag_a"))
    right = bag.select(F.col("row").alias("b"), F.col("bag").alias("bag_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "bag_a", "bag_b")
    measured = both.mapInArrow(_overlap, "a bigint, b bigint, shared bigint, either bigint")
    return measured.filter(F.col("shared") >= F.lit(similar) * F.col("either") - 1e-9).select("a", "b")


def across(members: DataFrame, bands: DataFrame, bag: DataFrame, similar: float) -> DataFrame:
    """Links ``a, b`` between ``part``s of a ``bucket``, enough of them to connect all parts that are linked at all.

    A bucket is cut into blocks by hash, and each pair of blocks is a tile with a task's bounded share of the work. A pair
    that shares several buckets is checked in the first one only, and not if links of its tile connect it already.
    """
    blocks = F.ceil(F.col("n") / TILE).cast("int")
    own = F.pmod(F.xxhash64("row"), blocks).cast("int")
    tiles = members.withColumns({"blocks": blocks, "own": own}).select(
        "bucket", "row", "size", "part", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )
    tiles = tiles.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    filled = tiles.join(bands, "row").join(bag, "row")
    filled = filled.repartition(parts_for(members.sparkSession), "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("bucket", "i", "j")), strict=True))
            values = (batch.column(c).to_pylist() for c in ("row", "size", "part", "own", "bands", "bag"))
            for this, row in zip(keys, zip(*values, strict=True), strict=True):
                if this != key:
                    if len(rows) > 1:
                        yield _tile(key, rows, similar)
                    key, rows = this, []
                rows.append(row)
        if len(rows) > 1:
            yield _tile(key, rows, similar)

    columns = ["bucket", "i", "j", "row", "size", "part", "own", "bands", "bag"]
    return filled.select(*columns).mapInArrow(run, "a bigint, b bigint")


def _tile(key: tuple[int, int, int], rows: list[tuple], similar: float) -> pa.RecordBatch:
    bucket, i, j = key
    number, size, part, own = (np.array([r[k] for r in rows]) for k in range(4))
    bands = np.array([r[4] for r in rows])
    bag = [np.frombuffer(r[5], np.uint64) for r in rows]
    band = int(np.flatnonzero(bands[0] == bucket)[0])
    root = {p: p for p in part.tolist()}

    def find(p: int) -> int:
        while root[p] != p:
            root[p] = p = root[root[p]]
        return p

    a, b = [], []
    right = own == j
    for x in np.flatnonzero(own == i):
        near = right & (part != part[x]) & (np.minimum(size, size[x]) >= similar * np.maximum(size, size[x]) - 1e-9)
        if i == j:
            near &= np.arange(len(rows)) > x
        if band:
            near &= ~(bands[:, :band] == bands[x, :band]).any(1)
        for y in np.flatnonzero(near):
            p, q = find(int(part[x])), find(int(part[y]))
            if p == q:
                continue
            shared = len(np.intersect1d(bag[x], bag[y], assume_unique=True))
            if shared >= similar * (len(bag[x]) + len(bag[y]) - shared) - 1e-9:
                root[p] = q
                a.append(min(number[x], number[y]))
                b.append(max(number[x], number[y]))
    return pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    row: str | None = None,
    words: int = WORDS,
    similar: float = SIMILAR,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: ``row, doc_id, class_id, class_size, kept``.

    A class is a connected component of rows whose bags of ``words``-word shingles have a weighted Jaccard similarity of
    ``similar`` or more. ``class_id`` is its smallest id (null only if all are null), and ``kept`` is true for
    one row of it, the first by id. Words are runs without white space. A text of fewer words is one
    shingle; texts without words (null, empty) have equal bags and are one class. ``row`` names a column of
    unique integers of a written table; without it rows are numbered here. Extra columns are not looked at.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    table = docs.select(
        number.alias("row"), F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    table = table if row else written(table, "near-texts")
    sketch = written(sketches(table, words, bands, rows), "sketches")

    # Copies: the row of the smallest number stands for all rows of its bag.
    key = ["key1", "key2", "size"]
    copies = sketch.groupBy(*key).agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("n"))
    copied = written(copies.filter("n > 1").select(*key, "rep"), "copies")
    member = sketch.select("row", *key).join(copied, key).select("row", "rep")
    member = written(member, "members")
    others = member.filter("row <> rep").select("row")
    single = sketch.filter("size > 0").join(others, "row", "left_anti")

    # Buckets with two members at least.
    every = written(single.select("row", "size", F.explode("bands").alias("bucket")), "bands")
    full = every.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    kept = written(every.join(full, "bucket"), "buckets")
    forget(every)
    near = written(kept.groupBy("row").agg(F.sum("n").alias("reach")), "reach")
    bag = written(bags(matching(table, near.select("row")), words), "bags")

    # First round: each member against the member of its bucket that shares buckets with most others.
    fits = F.least("size", F.col("hub.size")) >= F.lit(similar) * F.greatest("size", F.col("hub.size")) - 1e-9
    led = kept.join(near, "row")
    hubs = led.groupBy("bucket").agg(F.max_by(F.struct("row", "size"), F.struct("reach", F.xxhash64("row"))).alias("hub"))
    star = kept.join(hubs, "bucket").filter((F.col("row") != F.col("hub.row")) & fits)
    pairs = star.select(F.least("row", "hub.row").alias("a"), F.greatest("row", "hub.row").alias("b")).distinct()
    links = written(verified(pairs, bag, similar), "links")
    place = written(components(links).select(F.col("node").alias("row"), "root"), "components")

    # Second round: what shares a bucket and still lies in different components, in tiles of bounded size.
    now = kept.join(place, "row", "left").select("row", "size", "bucket", "n", F.coalesce("root", "row").alias("part"))
    parts = now.groupBy("bucket").agg(F.min("part").alias("least"), F.max("part").alias("most"))
    now = now.join(parts.filter("least < most").select("bucket"), "bucket")
    more = across(now, sketch.select("row", "bands"), bag, similar)
    links = written(links.union(more), "links")
    place = written(components(links).select(F.col("node").alias("row"), "root"), "components")

    # Class of a row: the component of its representative, or the representative itself.
    ids = table.select("row", "doc_id")
    stands = ids.join(member, "row", "left").select("row", "doc_id", F.coalesce("rep", "row").alias("rep"))
    root = place.select(F.col("row").alias("rep"), "root")
    classed = written(stands.join(root, "rep", "left").select("row", "doc_id", F.coalesce("root", "rep").alias("root")), "classes")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    groups = classed.groupBy("root").agg(first, F.count(F.lit(1)).alias("class_size"))
    return classed.join(groups, "root").select(
        "row",
        "doc_id",
        F.col("first.doc_id").alias("class_id"),
        "class_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each class of near duplicates, the first by id. Same columns."""
    row = fresh(docs, "row_number")
    table = numbered(docs, row)
    groups = near_groups(table, doc_id, text, row, **how)
    gone = written(groups.filter("NOT kept").select(F.col("row").alias(row)), "dropped")
    return matching(table, gone, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
