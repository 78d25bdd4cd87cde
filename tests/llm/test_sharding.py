import collections
import zlib

import pytest

from gaugeline.llm.sharding import _quotas, shard


def check(rows, shards):
    counts = collections.Counter(r.shard for r in rows)
    full = [counts.get(s, 0) for s in range(shards)]
    assert max(full) - min(full) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))


def test_even_shards_and_groups_together(spark):
    texts = [f"text number {i} stands alone here" for i in range(120)]
    for g in range(40):
        line = f"a line of some forty characters or more, group {g}"
        texts += [f"one {g}.{k}\n{line}" for k in range(3)]
        texts += [f"the same words in group {g}"] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = shard(df, shards=6, rounds=4).collect()
    check(rows, 6)
    by = {r.doc_id: r for r in rows}
    assert all(by[i].size == len(t.encode()) + 8 and by[i].text_crc32 == zlib.crc32(t.encode()) for i, t in enumerate(texts))
    places = collections.defaultdict(set)
    for i, t in enumerate(texts):
        places[t].add(by[i].shard)
        if "\n" in t:
            places[t.split("\n")[1]].add(by[i].shard)
    linked = [k for k in places if "group" in k and ("line" in k or "same" in k) and "\n" not in k]
    assert sum(len(places[k]) > 1 for k in linked) <= 0.25 * len(linked)


def test_hot_group_fills_whole_shards(spark):
    df = spark.range(300).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS text")
    rows = shard(df, shards=6).collect()
    check(rows, 6)
    assert len({r.shard for r in rows if r.doc_id % 3 == 0}) <= 4


def test_odd_rows(documents, nothing):
    rows = shard(documents, shards=4).collect()
    assert len(rows) == documents.count()
    check(rows, 4)
    assert sorted(r.size for r in rows if r.doc_id in (3, 4)) == [8, 8]
    assert shard(nothing).count() == 0


@pytest.mark.parametrize("free", [[0, 0, 0], [5, 0, 9], [100, 100, 100]])
def test_quotas_hold(free):
    wanted = [[0, 7, 3], [2, 0, 50], [9, 1, 0]]
    quota = _quotas(wanted, free)
    for b in range(3):
        assert sum(quota[a][b] for a in range(3)) - sum(quota[b]) <= free[b]
        assert all(0 <= quota[a][b] <= wanted[a][b] for a in range(3))


def test_no_python_on_the_path(documents):
    plan = shard(documents, shards=4)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
