import math

import numpy as np
from pyspark.sql import functions as F

from gaugeline.llm.neighbours import nearest
from gaugeline.llm.queries import op5_neighbours


def test_recall_and_scores(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = {}
    for r in op5_neighbours(spark, sf_dir).collect():
        got.setdefault(r.query_id, []).append(r)
    assert sorted(got) == [i for i in range(len(x)) if i % 50 == 0]
    hits = 0
    for q, own in got.items():
        own.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5]
        assert all(a.score >= b.score for a, b in zip(own, own[1:], strict=False))
        assert all(abs(r.score - unit[q] @ unit[r.vec_id]) < 1e-12 and r.vec_id != q for r in own)
        cosine = unit @ unit[q]
        cosine[q] = -2
        hits += len(set(np.argsort(-cosine)[:5]) & {r.vec_id for r in own})
    assert hits >= 0.9 * 5 * len(got)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]),
        (5, [math.nan, 1.0]), (6, [None, 1.0]), (7, [math.inf, 1.0]), (50, [0.0, 2.0]), (None, [1.0, 1.0]), (100, [1.0, 2.0, 3.0]),
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<float>, `row` int, dims string")
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in nearest(df, F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 2, 1.0), (0, 4, 50, 0.0), (50, 1, 0, 0.0), (50, 2, 1, 0.0), (50, 3, 2, 0.0), (50, 4, 2, 0.0)]
    assert nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
