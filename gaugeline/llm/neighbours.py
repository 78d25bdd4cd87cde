"""Approximate nearest neighbours by cosine: a forest of sorted hash strings.

A tree gives each vector a long string of bits, one per random plane, and keeps the strings sorted. The vectors that
share the longest prefix with a query lie around the query's place, so the descent is a binary search. From
there all trees ascend together, one bit at a time, until the vectors below the reached prefixes make up enough
candidates; these are measured exactly.

Vectors are dealt by hash into blocks of bounded size, each with a forest of its own, and queries visit every block, in
chunks of bounded size too; the best of all blocks are the result. No prefix or bucket is capped, and an ascent
that reaches the root measures the whole block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import written

TREES, BITS = 64, 32
# Entries below the reached prefixes, of all trees together, as a share of a block's vectors.
REACH = 0.75
BLOCK, QUERIES = 8192, 2048
SEED = 77


class Forest:
    """Sorted bit strings of the rows of ``vectors`` in each tree."""

    def __init__(self, vectors: np.ndarray, trees: int, bits: int) -> None:
        rng = np.random.default_rng(SEED)
        self.planes = [rng.standard_normal((vectors.shape[1], bits)) for _ in range(trees)]
        self.bits = bits
        self.order, self.sorted = [], []
        for plane in self.planes:
            code = self.codes(vectors, plane)
            order = np.argsort(code, kind="stable")
            self.order.append(order)
            self.sorted.append(code[order])

    def codes(self, vectors: np.ndarray, plane: np.ndarray) -> np.ndarray:
        weights = np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64)
        return ((vectors @ plane) > 0) @ weights

    def ranges(self, queries: np.ndarray) -> np.ndarray:
        """``[query, tree, level, 2]``: where the entries with the query's first ``level`` bits begin and end."""
        out = np.empty((len(queries), len(self.planes), self.bits + 1, 2), np.int32)
        for t, plane in enumerate(self.planes):
            code = self.codes(queries, plane)
            for level in range(self.bits + 1):
                shift = np.uint64(self.bits - level)
                low = (code >> shift) << shift
                out[:, t, level, 0] = np.searchsorted(self.sorted[t], low)
                out[:, t, level, 1] = np.searchsorted(self.sorted[t], low + (np.uint64(1) << shift))
        return out


def _search(points: pd.DataFrame, queries: pd.DataFrame, k: int, trees: int, bits: int, reach: float) -> pd.DataFrame:
    columns = ["query_row", "query_id", "row", "vec_id", "score"]
    if points.empty or queries.empty:
        return pd.DataFrame({c: [] for c in columns})
    x = np.stack(points["vector"].to_list()).astype(np.float64)
    q = np.stack(queries["vector"].to_list()).astype(np.float64)
    norm, q_norm = np.sqrt((x * x).sum(1)), np.sqrt((q * q).sum(1))
    ids, rows = points["vec_id"].to_numpy(), points["row"].to_numpy()
    forest = Forest(x / norm[:, None], trees, bits)
    found = []
    for at in range(0, len(q), 64):
        spans = forest.ranges(q[at : at + 64] / q_norm[at : at + 64, None])
        for i, span in enumerate(spans, at):
            total = (span[:, :, 1] - span[:, :, 0]).sum(0)
            level = int(np.flatnonzero(total >= reach * len(x))[-1])
            own = rows == queries["row"].iat[i]
            while True:
                near = np.zeros(len(x), bool)
                for order, (begin, end) in zip(forest.order, span[:, level], strict=True):
                    near[order[begin:end]] = True
                near &= ~own
                if level == 0 or near.sum() >= k:
                    break
                level -= 1
            at_row = np.flatnonzero(near)
            # Row by row in one order, so that equal vectors get equal scores.
            score = (x[at_row] * q[i]).sum(1) / (norm[at_row] * q_norm[i])
            best = np.lexsort((rows[at_row], ids[at_row], -score))[:k]
            found.append(
                pd.DataFrame(
                    {
                        "query_row": queries["row"].iat[i],
                        "query_id": queries["vec_id"].iat[i],
                        "row": rows[at_row[best]],
                        "vec_id": ids[at_row[best]],
                        "score": score[best],
                    }
                )
            )
    return pd.concat(found)[columns]


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    trees: int = TREES,
    bits: int = BITS,
    reach: float = REACH,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each row where ``is_query`` holds.

    Cosine on the original vectors in double precision, nearest first, ties to the smaller id. Candidates are all rows but
    the query's own, also those with its id; fewer than ``k`` rows are all returned. Vectors that are null or
    zero or hold a null or a number that isn't finite take no part, nor do rows without an id; vectors of another
    number of components than the query's are no candidates. Extra columns are not looked at.
    """
    table = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(vector).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    value = F.col("vector").cast("array<double>")
    sound = F.forall(value, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    table = written(table.filter(sound & F.exists(value, lambda c: c != 0)).withColumn("dims", F.size("vector")), "vectors")
    counts = table.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    blocks, chunks = (max(1, -(-n // size)) for n, size in zip(counts, (BLOCK, QUERIES), strict=True))
    block, chunk = F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(blocks)), F.pmod(F.xxhash64(F.lit(2), "row"), F.lit(chunks))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    points = table.select("row", "vec_id", "vector", "dims", block.cast("int").alias("block"), every(chunks).alias("chunk"))
    queries = table.filter("asks").select(
        "row", "vec_id", "vector", "dims", chunk.cast("int").alias("chunk"), every(blocks).alias("block")
    )
    key = ["dims", "block", "chunk"]
    best = (
        points.groupBy(*key)
        .cogroup(queries.groupBy(*key))
        .applyInPandas(
            lambda left, right: _search(left, right, k, trees, bits, reach),
            "query_row bigint, query_id bigint, row bigint, vec_id bigint, score double",
        )
    )
    order = Window.partitionBy("query_row", "query_id").orderBy(F.desc("score"), "vec_id", "row")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
