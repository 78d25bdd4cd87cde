import collections

import numpy as np
import pytest

from gaugeline.llm import near_dedup
from gaugeline.llm.near_dedup import _weighted, drop_near_copies, near_groups, signatures


def bag(text):
    words = (text or "").split()
    return collections.Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else collections.Counter()


def classes(texts):
    bags, root = [bag(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(bags)):
        for j in range(i):
            either = sum((bags[i] | bags[j]).values())
            if not either or sum((bags[i] & bags[j]).values()) >= 0.8 * either - 1e-9:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in range(len(texts))}


@pytest.mark.parametrize("n", [5, 60, 400])
def test_registers_agree_as_often_as_bags_overlap(n):
    rng = np.random.default_rng(n)
    a = [f"w{i}" for i in rng.integers(0, 3 * n, n)]
    b = [*a[: n - max(1, n // 10)], "other", *a[: n // 5]]
    value, text, weight = _weighted([" ".join(a), " ".join(b)], 1)
    one, two = collections.Counter(a), collections.Counter(b)
    register = signatures(value, text, weight, 2, 20_000)
    assert (register[0] == register[1]).mean() == pytest.approx(sum((one & two).values()) / sum((one | two).values()), abs=0.02)


def test_groups_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(200):  # a family around one text, of similarity about 0.8
        own = list(base)
        for i in rng.choice(150, int(rng.integers(0, 9)), replace=False):
            own[i] = f"x{rng.integers(0, 10**6)}"
        texts.append(" ".join(own))
    for n in range(30):
        own = [f"v{n}_{i}" for i in range(40)]
        texts += [" ".join(own), " ".join([*own[:-1], "end"])]
    texts += ["a b", "a b", "a  b\n", "", None, " ", "one", "one two three four five six", *texts[:5]]
    monkeypatch.setattr(near_dedup, "TILE", 32)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = near_groups(df).collect()
    want = classes(texts)
    assert {r.doc_id: r.class_id for r in got} == want
    assert {r.doc_id for r in got if r.kept} == set(want.values())
    sizes = collections.Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] for r in got)


def test_odd_rows(documents, nothing):
    got = near_groups(documents).collect()
    assert len(got) == documents.count()
    assert sum(r.kept for r in got) == len({(r.class_id, r.class_size) for r in got})
    assert {r.doc_id: r.class_id for r in got if r.doc_id} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 3, 6: 6, 7: 6, 8: 8, 9: 9, 10: 10}
    stay = drop_near_copies(documents)
    assert stay.columns == documents.columns
    assert sorted(r.doc_id for r in stay.collect()) == [1, 3, 6, 8, 9, 10]
    assert near_groups(nothing).count() == 0 and drop_near_copies(nothing).count() == 0
