import hashlib
import re
from collections import defaultdict

import pytest

from gaugeline.llm.mixing import mix, mixed, targets


def shares(sizes, weights=(1, 2, 3), epochs=3):
    """Targets by sharing again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(epochs * sizes[s] for s in full)
        of = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and left * weight[s] > epochs * sizes[s] * of}
        if not over:
            return {s: float(epochs * sizes[s]) if s in full else left * weight[s] / max(of, 1) for s in names}
        full |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1, "c": 2, None: 50}, {"x": 5}, {"a": 0, "b": 0}, {"ä": 7, "z": 900, "é": 3, "b": 4}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in targets(df).collect()}
    assert got == pytest.approx(shares(sizes))


def test_mix_equals_brute_force(documents):
    rows = [(r.doc_id, r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in documents.select("doc_id", "source", "text").collect()]
    sizes = defaultdict(int)
    for _, source, n in rows:
        sizes[source] += n
    target = shares(sizes)
    want = []
    for source, size in sizes.items():
        budget = int(target[source] + 0.5)
        whole, rest = divmod(budget, size) if size else (0, 0)
        own = sorted((r for r in rows if r[1] == source), key=lambda r: (hashlib.md5(str(r[0] if r[0] is not None else "").encode()).hexdigest(), r[0] or 0, r[2]))
        for i, _, n in own:
            part = max(0, min(n, rest))
            rest -= n
            want.append((i, n, size, whole * n + part))
    got = mix(documents).collect()
    assert sorted(((r.doc_id, r.size, r.source_size, r.taken) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.taken <= 3 * r.size for r in got)
    again = mix(documents.repartition(3)).collect()
    assert sorted((r.doc_id, r.taken) for r in got if r.doc_id) == sorted((r.doc_id, r.taken) for r in again if r.doc_id)


def test_stage_gives_the_words(documents, nothing):
    out = mixed(documents)
    assert out.columns == documents.columns
    given = defaultdict(int)
    for r in out.select("source", "text").collect():
        given[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want = defaultdict(int)
    for r in mix(documents).collect():
        want[r.source] += r.taken
    assert {s: n for s, n in given.items() if n} == {s: n for s, n in want.items() if n}
    assert mixed(nothing).count() == 0
    assert mix(nothing).count() == 0


def test_stage_takes_any_column_names(documents):
    clashing = documents.selectExpr("*", "1 AS _whole_", "2 AS _rest_", "3 AS whole_copies", "4 AS rest_words", "5 AS copy_number")
    out = mixed(clashing)
    assert out.columns == clashing.columns
    assert {tuple(r) for r in out.select("_whole_", "_rest_", "whole_copies", "rest_words", "copy_number").collect()} == {(1, 2, 3, 4, 5)}
