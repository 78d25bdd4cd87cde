"""Scores of texts by context-tree weighting over bytes, beside a plain model of words.

Each byte is eight binary decisions; each decision mixes the Krichevsky-Trofimov estimates of all contexts of 0 to ``depth``
bytes before it, weighted by how well each predicted the training texts (``context_tree``). A text's end is a
symbol too, so the probabilities of all texts sum to one.

Counts don't depend on an order, so the whole model is sums over *grams* (``depth`` bytes and the one after them):

1. Tasks cut the rows into blocks of bounded size and write their texts packed, with each block's distinct grams and
   words, counted where they stand in training texts.
2. Grams are summed by key and dealt into parts by the three nearest bytes; each part holds whole subtrees and settles
   them. Depth 2 is settled from the parts' sums, depths 0 and 1 (a fixed number of nodes) in the driver.
3. Each gram gets its probability once. The values go back to the blocks that have the gram, packed by block before the
   shuffle, and every block scores its texts.

Nothing that grows with the corpus is broadcast: a task holds one block and the values of its own grams.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm import context_tree as tree
from gaugeline.llm.common import forget, written

# Bytes of context; 3 to 6, as a gram has to fit 63 bits.
DEPTH = 5
# Bytes of text in a block and in a packed row of it (one text at least).
BLOCK = 32 << 20
PACK = 1 << 20
# Grams of a block that wait to be merged with those before them; as many as these, if they are more.
WAITING = 1 << 19
# Bytes of grams or words that a task holds while it packs them by block.
HELD = 16 << 20
# Grams of a part of the tree, about; a task holds some 600 bytes for each.
PART = 300_000
# Context bytes that name a subtree.
SUBTREE = 3


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _texts(batch: pa.RecordBatch | pa.Table) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass").lower() for t in batch.column("text").to_pylist()]


def _merged(grams: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate(grams)
    order = np.argsort(every)
    every = every[order]
    begin = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
    return every[begin], np.add.reduceat(np.concatenate(counts)[order], begin) if len(begin) else begin


def _counted(texts: list[bytes]) -> pa.Table:
    """``word, n``: distinct words and ends of texts, and how often they occur."""
    words = pa.array([*chain.from_iterable(t.split() for t in texts), *[b""] * len(texts)], pa.binary()).value_counts()
    return pa.table({"word": words.field("values"), "n": words.field("counts")})


def _summed(tables: list[pa.Table]) -> pa.Table:
    """One row per word of ``word, n``."""
    out = pa.concat_tables(tables).group_by("word", use_threads=False).aggregate([("n", "sum")])
    return pa.table({"word": out.column("word"), "n": out.column("n_sum")})


def _release() -> None:
    """Gives back what Arrow keeps for later, as a worker shares its memory with others."""
    pa.default_memory_pool().release_unused()


class _Block:
    """Distinct grams and words of a block, with their counts in training texts."""

    def __init__(self, depth: int) -> None:
        self.depth, self.size, self.waiting = depth, 0, 0
        self.grams: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.counts: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.words: list[pa.Table] = [_counted([])]

    def add(self, texts: list[bytes], learned: list[bool]) -> None:
        for wanted in (True, False):
            chosen = [t for t, is_learned in zip(texts, learned, strict=True) if is_learned == wanted]
            if not chosen:
                continue
            found, _ = tree.text_grams(chosen, self.depth)
            key, count = np.unique(found, return_counts=True)
            self.grams.append(key)
            self.counts.append(count if wanted else count * 0)
            self.waiting += len(key)
            words = _counted(chosen)
            if not wanted:
                # An end is no word of a text that isn't learned from.
                words = words.filter(pc.not_equal(words.column("word"), b""))
                words = words.set_column(1, "n", pa.array(np.zeros(len(words), np.int64)))
            self.words.append(words)
        self.size += sum(map(len, texts))
        if self.waiting > max(WAITING, len(self.grams[0])):
            self._merge()

    def _merge(self) -> None:
        key, count = _merged(self.grams, self.counts)
        self.grams, self.counts, self.waiting = [key], [count], 0
        self.words = [_summed(self.words)]
        _release()

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        self._merge()
        key, count = self.grams[0], self.counts[0]
        for at in range(0, len(key), 1 << 16):
            yield _rows(block, gram=pa.array(key[at : at + (1 << 16)]), n=pa.array(count[at : at + (1 << 16)]))
        for words in self.words[0].to_batches(1 << 16):
            if words.num_rows:
                yield _rows(block, word=words.column("word"), n=words.column("n"))


_BLOCK_ROWS = {"texts": pa.binary(), "gram": pa.int64(), "word": pa.binary(), "n": pa.int64()}


def _rows(block: int, **columns: pa.Array) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    filled = {name: columns.get(name, pa.nulls(size, kind)) for name, kind in _BLOCK_ROWS.items()}
    return pa.record_batch({"block": pa.array(np.full(size, block, np.int64)), **filled})


def _parts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of a bounded number of bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    begin, size = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and size + n > PACK:
            yield batch.slice(begin, i - begin)
            begin, size = i, 0
        size += int(n)
    if begin < batch.num_rows:
        yield batch.slice(begin)


def _blocks(docs: DataFrame, depth: int, block_bytes: int) -> DataFrame:
    """``block`` with either packed ``texts``, or a ``gram`` or ``word`` and its number ``n`` in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block = _Block(depth)
        for batch in batches:
            for part in _parts_of(batch):
                yield _rows(number, texts=pa.array([_packed(part)], pa.binary()))
                block.add(_texts(part), part.column("learned").to_pylist())
                if block.size >= block_bytes:
                    yield from block.rows(number)
                    number, block = number + 1, _Block(depth)
        yield from block.rows(number)

    return docs.mapInArrow(run, "block bigint, texts binary, gram bigint, word binary, n bigint")


def _gram_values(counted: DataFrame, depth: int) -> DataFrame:
    """``gram, value``: the base-10 logarithm of each gram's probability, from ``gram, n``."""
    parts = max(1, math.ceil(counted.count() / PART))
    dealt = counted.withColumn("part", F.pmod(F.xxhash64(F.shiftrightunsigned("gram", 8 * (depth + 1 - SUBTREE))), F.lit(parts)))
    top, second = _settled(dealt, depth)
    return _valued(dealt, second, top, depth)


def _sorted_grams(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    gram, n = rows.column("gram").to_numpy(), rows.column("n").to_numpy()
    order = np.argsort(gram, kind="stable")
    return gram[order], n[order].astype(np.int64)


def _settled(dealt: DataFrame, depth: int) -> tuple[tree.Top, DataFrame]:
    """Depths 0 and 1, and a written table of depth 2: ``context, node, weight, one``."""

    def up(rows: pa.Table) -> pa.Table:
        levels = tree.upward(*_sorted_grams(rows), depth, SUBTREE)
        names = ["context", "node", "zeros", "ones", "product"]
        return pa.table(dict(zip(names, tree.to_parent(levels, SUBTREE), strict=True)))

    sums = dealt.filter("n > 0").groupBy("part").applyInArrow(up, "context bigint, node bigint, zeros bigint, ones bigint, product double")
    sums = sums.groupBy("context", "node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("product").alias("product"))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            zeros, ones, product = (batch.column(c).to_numpy() for c in ("zeros", "ones", "product"))
            weight, one, weighted = tree.settle(zeros, ones, product)
            kept = {c: batch.column(c) for c in ("context", "node", "zeros", "ones")}
            yield pa.record_batch({**kept, "weight": pa.array(weight), "one": pa.array(one), "weighted": pa.array(weighted)})

    kind = "context bigint, node bigint, zeros bigint, ones bigint, weight double, one double, weighted double"
    second = written(sums.mapInArrow(settle, kind), "second")
    # At most 256 contexts of 255 nodes.
    first = second.groupBy(F.shiftright("context", 8).alias("context"), "node")
    rows = first.agg(F.sum("zeros"), F.sum("ones"), F.sum("weighted")).collect()
    columns = [np.array([r[i] for r in rows], np.float64 if i == 4 else np.int64) for i in range(5)]
    return tree.Top.of(*columns), second.select("context", "node", "weight", "one")


def _valued(dealt: DataFrame, second: DataFrame, top: tree.Top, depth: int) -> DataFrame:
    # A part gets the nodes of depth 2 above its subtrees, as rows of its own.
    context = F.shiftrightunsigned("gram", 8 * (depth - 1)).alias("context")
    above = second.join(dealt.select("part", context).distinct(), "context")
    null = F.lit(None).cast("bigint")
    rows = dealt.select("part", "gram", "n", null.alias("node"), null.cast("double").alias("weight"), null.cast("double").alias("one"))
    rows = rows.union(above.select("part", F.col("context").alias("gram"), null, "node", "weight", "one"))

    def value(rows: pa.Table) -> pa.Table:
        upper = rows.filter(pc.is_valid(rows.column("node")))
        key = upper.column("gram").to_numpy() << 8 | upper.column("node").to_numpy()
        order = np.argsort(key)
        nodes = [key[order], upper.column("weight").to_numpy()[order], upper.column("one").to_numpy()[order]]
        gram, n = _sorted_grams(rows.filter(pc.is_null(rows.column("node"))).select(["gram", "n"]))
        chances = tree.mixed_chances(tree.upward(gram, n, depth, SUBTREE))
        chances = top.mix(tree.mix_second(chances, gram, depth, *nodes), gram, depth)
        return pa.table({"gram": gram, "value": np.log10(chances).sum(0)})

    return rows.groupBy("part").applyInArrow(value, "gram bigint, value double")


def _by_block(rows: DataFrame) -> DataFrame:
    """``block, rows``: the other columns of a block's rows, packed by the task that holds them, a bounded number at a time."""

    def pack(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        block = table.column("block").to_numpy()
        order = np.argsort(block, kind="stable")
        block = block[order]
        begin = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        table = table.drop_columns("block").take(pa.array(order))
        for at, end in zip(begin.tolist(), [*begin[1:].tolist(), len(block)], strict=True):
            packed = _packed(table.slice(at, end - at).combine_chunks().to_batches()[0])
            yield pa.record_batch({"block": pa.array(block[at : at + 1]), "rows": pa.array([packed], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= HELD:
                yield from pack(held)
                held, size = [], 0
                _release()
        if held:
            yield from pack(held)

    return rows.mapInArrow(run, "block bigint, rows binary")


def _gram_table(packed: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted grams and their values, of packed rows."""
    tables = [_unpacked(part) for part in packed.drop_null()]
    key, value = (np.concatenate([t.column(c).to_numpy() for t in tables]) for c in ("gram", "value"))
    del tables
    order = np.argsort(key)
    return key[order], value[order]


def _logarithms(count: Counter[bytes], out_of: int) -> dict[bytes, float]:
    """Logarithms of the words' probabilities, in place of their counts; like counts share one number."""
    log10 = {c: math.log10((c + 1) / out_of) for c in set(count.values())}
    for word, c in count.items():
        count[word] = log10[c]
    return count


def scored(
    docs: DataFrame, learned: Column, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH, block_bytes: int = BLOCK
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, learned, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte``.

    Texts are read with A-Z in lower case. The models learn from rows where ``learned`` is true and score all. Tokens
    are runs without white space and one end per text; ``base_score`` sums ``log10((c + 1) / (N + V + 1))`` over them (c: the
    token's count, N: all, V: distinct, in training texts), ``n_known`` counts those with c > 0. ``score`` is the base-10
    logarithm of the text's probability, end included, in the context tree; ``bits_per_byte`` its code length over the
    bytes and the end.

    Null texts are empty, and an empty text has one token, its end. Null in ``learned`` is false. Repeated rows are learned
    and scored each. Where nothing is learned each bit costs one bit, and ``train_tokens`` is 0. An empty table gives no
    rows. A very long text makes a block of its own and is held whole by one task, with some 40 bytes for each
    of its bytes. Extra columns are not looked at.
    """
    if not SUBTREE <= depth <= 6:
        raise ValueError("depth must be 3 to 6")
    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.coalesce(learned, F.lit(False)).alias("learned")
    )
    table = written(_blocks(narrow, depth, block_bytes), "blocks")
    grams = table.filter("gram IS NOT NULL").select("block", "gram", "n")
    counted = written(grams.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    values = written(_gram_values(counted, depth), "values")
    forget(counted)

    # A word has one row per block that holds it.
    same = Window.partitionBy("word")
    total = F.sum("n").over(same).alias("c")
    place = F.row_number().over(same.orderBy("block")).alias("place")
    words = written(table.filter("word IS NOT NULL").select("block", "word", "n", total, place), "words")
    n_all, n_distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when((F.col("place") == 1) & (F.col("c") > 0), 1))).first()
    out_of = n_all + n_distinct + 1

    # A block knows its own counts of words; it is told those that differ.
    told = _by_block(grams.join(values, "gram").select("block", "gram", "value")).withColumnRenamed("rows", "grams")
    told = told.unionByName(
        _by_block(words.filter("c <> n").select("block", "word", "c")).withColumnRenamed("rows", "words"), allowMissingColumns=True
    )
    texts = table.filter("texts IS NOT NULL").select(F.col("block").alias("of"), "texts")

    def score(packed: pa.Table, told: pa.Table) -> pa.Table:
        key, value = _gram_table(told.column("grams"))
        parts = packed.column("texts")
        count: Counter[bytes] = Counter()
        for part in parts:
            rows = _unpacked(part)
            for words_of, is_learned in zip(_texts(rows), rows.column("learned").to_pylist(), strict=True):
                if is_learned:
                    count.update(words_of.split())
                    count[b""] += 1
        for part in told.column("words").drop_null():
            rows = _unpacked(part)
            for word, c in zip(rows.column("word").to_pylist(), rows.column("c").to_pylist(), strict=True):
                count[word] = c
        base = _logarithms(count, out_of)
        _release()
        return pa.concat_tables([_scores(_unpacked(part), key, value, base, math.log10(1 / out_of)) for part in parts])

    def _scores(rows: pa.Table, key: np.ndarray, value: np.ndarray, base: dict[bytes, float], unknown: float) -> pa.Table:
        texts = _texts(rows)
        n_tokens, n_known, base_score = [], [], []
        for t in texts:
            each = [*map(base.get, t.split()), base.get(b"")]
            missing = each.count(None)
            n_tokens.append(len(each))
            n_known.append(len(each) - missing)
            base_score.append(math.fsum(x for x in each if x is not None) + missing * unknown)
        found, begin = tree.text_grams(texts, depth)
        # A text's grams repeat: each is looked up once, in order.
        own, place = np.unique(found, return_inverse=True)
        log10 = np.add.reduceat(value[np.searchsorted(key, own)][place], begin)
        size = np.array([len(t) for t in texts], np.int64)
        return pa.table(
            {
                "doc_id": rows.column("doc_id"),
                "learned": rows.column("learned"),
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "n_known": pa.array(n_known, pa.int64()),
                "train_tokens": pa.array(np.full(len(texts), n_all, np.int64)),
                "base_score": pa.array(base_score, pa.float64()),
                "score": pa.array(log10),
                "n_bytes": pa.array(size),
                "bits_per_byte": pa.array(-log10 * math.log2(10) / (size + 1)),
            }
        )

    result = (
        f"doc_id {kind}, learned boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double, n_bytes bigint, bits_per_byte double"
    )
    return texts.groupBy("of").cogroup(told.groupBy("block")).applyInArrow(score, result)


def _unpacked(part: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(part.as_buffer()).read_all()
