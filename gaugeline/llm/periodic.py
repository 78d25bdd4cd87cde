"""Runs of repeated words in texts: maximal stretches of a smallest period, repeated at least four times.

Per text, suffixes are sorted and united into classes by decreasing length of their common prefix (Kruskal over
neighbours in suffix order). A class keeps its positions in order. Two positions that become neighbours in a class when it is
made at length l, at distance d <= l, are the first and second period of a stretch of period d and length
l + d; it is a run if the words before them differ.

Each run is found, and found once, for a run of period q and length L >= 2q that begins at s: the common prefix of s and
s + q is exactly L - q >= q. Were a position between them in their class then, the stretch would have two periods whose
sum fits into it, and so their common divisor, which is below q. So they become neighbours when they unite. Nor is a
stretch found whose smallest period p is below d: then s + p is in the class before s + d, and lies between.

Only runs of at least ``max(least, repeats * period)`` words count. Their first suffixes share a prefix of five words or more,
so a text in which no five words stand twice (by hashes, which only ever let too many pass) holds none.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.shingles import held, mix64, slices

LEAST = 6
REPEATS = 4

Run = tuple[int, int, int]


def suffix_order(ids: np.ndarray) -> np.ndarray:
    """Positions in order of the words that follow, by doubling: ranks of 1, 2, 4... words until all differ."""
    n = len(ids)
    _, rank = np.unique(ids, return_inverse=True)
    rank = rank.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    width = 1
    while True:
        follows = np.full(n, -1, np.int64)
        follows[: max(n - width, 0)] = rank[width:]
        key = rank * (n + 1) + follows + 1
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        steps = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        rank[order] = steps
        if steps[-1] == n - 1:
            return order
        width *= 2


def common_prefixes(ids: list[int], order: list[int]) -> list[int]:
    """For each place in ``order`` the number of words its suffix shares with the one before (0 for the first)."""
    n = len(ids)
    place = [0] * n
    for i, p in enumerate(order):
        place[p] = i
    out, length = [0] * n, 0
    for p in range(n):
        at = place[p]
        if at:
            other = order[at - 1]
            most = n - max(p, other)
            while length < most and ids[p + length] == ids[other + length]:
                length += 1
            out[at] = length
            length = max(length - 1, 0)
        else:
            length = 0
    return out


def neighbours_made(large: list[int], small: list[int]) -> list[tuple[int, int]]:
    """Pairs of positions that stand side by side only once both ordered lists are one."""
    out = []
    for i, x in enumerate(small):
        at = bisect_left(large, x)
        if at and (not i or small[i - 1] < large[at - 1]):
            out.append((large[at - 1], x))
        if at < len(large) and (i + 1 == len(small) or small[i + 1] > large[at]):
            out.append((x, large[at]))
    return out


def runs(words: list, least: int = LEAST, repeats: int = REPEATS) -> list[Run]:
    """``start, length, period`` of each run of at least ``max(least, repeats * period)`` words (``repeats`` >= 2), in order."""
    # A run's prefix: length less period.
    shortest = max(least - least // repeats, repeats - 1, 1)
    numbers: dict = {}
    ids = [numbers.setdefault(w, len(numbers)) for w in words]
    if len(ids) < 2:
        return []
    order = suffix_order(np.array(ids, np.int64)).tolist()
    shared = common_prefixes(ids, order)
    lengths = np.array(shared)
    edges = np.flatnonzero(lengths >= shortest)
    edges = edges[np.argsort(-lengths[edges], kind="stable")].tolist()
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def root(p: int) -> int:
        while (up := parent.setdefault(p, p)) != p:
            parent[p] = p = parent[up]
        return p

    found = []
    for at in edges:
        length = shared[at]
        a, b = root(order[at - 1]), root(order[at])
        one, two = members.pop(a, [a]), members.pop(b, [b])
        if len(one) < len(two):
            a, b, one, two = b, a, two, one
        for p, q in neighbours_made(one, two):
            d = q - p
            if length + d >= max(least, repeats * d) and (not p or ids[p - 1] != ids[q - 1]):
                found.append((p, length + d, d))
        if 16 * len(two) < len(one):
            for x in two:
                insort(one, x)
        else:
            one = sorted(one + two)
        parent[b] = a
        members[a] = one
    found.sort(key=lambda r: (r[0], r[2]))
    return found


def strongest(found: list[Run]) -> Run | None:
    """The run of greatest length by period, exactly; ties to the smallest start, then period."""
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list, found: list[Run]) -> list:
    """Words without those that a run holds after its first period."""
    if not found:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return [w for w, depth in zip(words, np.cumsum(change).tolist(), strict=False) if not depth]


def with_repeats(texts: list[list[bytes]], width: int) -> np.ndarray:
    """Which texts hold some ``width`` words twice; hashes that clash let a few more pass."""
    sizes = np.array([len(t) for t in texts], np.int64)
    total = int(sizes.sum())
    out = np.zeros(len(texts), bool)
    if total < width:
        return out
    ids = np.fromiter((hash(w) for t in texts for w in t), np.int64, total).astype(np.uint64)
    text = np.repeat(np.arange(len(texts)), sizes)
    value = mix64(text[: total - width + 1])
    for i in range(width):
        value = mix64(value * np.uint64(0xD1342543DE82EF95) + ids[i : total - width + 1 + i])
    inside = text[: total - width + 1] == text[width - 1 :]
    value, text = value[inside], text[: total - width + 1][inside]
    order = np.argsort(value)
    again = value[order][1:] == value[order][:-1]
    out[text[order[1:][again]]] = True
    return out


def id_hash(doc_id: object) -> int:
    """CRC-32 of an id as decimal text; a null id counts as empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def looped(words: list, h: int) -> list:
    """The trial change of every tenth id: from a place on, a text repeats its next few words to its end."""
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def periodic_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, repeats: int = REPEATS, trial: bool = False
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, runs, best, text``.

    Words are runs without white space. ``runs`` lists ``start, length, period`` in words, by start, then period;
    ``best`` is the one of greatest length by period (null without runs); ``text`` is the text without the words that
    a run repeats, joined by one space. ``trial`` first changes every tenth text as ``looped`` says, to plant runs.

    Null and empty texts have no words and no runs. Texts are read whole; a very long one alone, with some 200 bytes per
    word. Of equal shares the first run is best. Repeated rows are answered each, an empty table gives no rows, extra
    columns are not looked at.
    """
    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()
    run_type = pa.struct({"start": pa.int64(), "length": pa.int64(), "period": pa.int64()})
    width = max(least - least // repeats, repeats - 1, 1)

    def row(run: Run) -> dict[str, int]:
        return dict(zip(("start", "length", "period"), run, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in held(batches):
            ids = batch.column("doc_id").to_pylist()
            for first, part in slices([t or "" for t in batch.column("text").to_pylist()]):
                texts = [t.encode("utf-8", "surrogatepass").split() for t in part]
                if trial:
                    texts = [looped(t, id_hash(i)) for t, i in zip(texts, ids[first:], strict=False)]
                found = [runs(t, least, repeats) if some else [] for t, some in zip(texts, with_repeats(texts, width), strict=True)]
                best = [strongest(f) for f in found]
                kept = [b" ".join(collapsed(t, f)).decode("utf-8", "surrogatepass") for t, f in zip(texts, found, strict=True)]
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(first, len(part)),
                        "n_words": pa.array([len(t) for t in texts], pa.int64()),
                        "runs": pa.array([[row(r) for r in f] for f in found], pa.list_(run_type)),
                        "best": pa.array([b and row(b) for b in best], run_type),
                        "text": pa.array(kept, pa.string()),
                    }
                )

    fields = "start: bigint, length: bigint, period: bigint"
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id {kind}, n_words bigint, runs array<struct<{fields}>>, best struct<{fields}>, text string")
