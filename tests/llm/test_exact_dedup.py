import hashlib
import re

import pytest

from gaugeline.llm.exact_dedup import drop_copies, exact_groups


def expected(rows):
    plain = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    groups = {}
    for i, t in plain:
        groups.setdefault(t, []).append(i)
    out = []
    for i, t in plain:
        ids = [x for x in groups[t] if x is not None]
        out.append((i, min(ids) if ids else None, len(groups[t]), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr), len(groups)


@pytest.mark.parametrize("block", [3, 1024])
def test_groups_equal_brute_force(documents, block):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    want, groups = expected(rows)
    got = exact_groups(documents, block=block).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == groups
    assert all(r.doc_id == r.keep_id for r in kept)


def test_texts_of_equal_blocks_in_other_order_differ(spark):
    texts = ["abcabd", "abdabc", "abcabd", "abcabc", "abc", "abcabcabc", "", "abcabcab"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_groups(df, block=3).collect()}
    assert got == {0: (0, 2), 1: (1, 1), 2: (0, 2), 3: (3, 1), 4: (4, 1), 5: (5, 1), 6: (6, 1), 7: (7, 1)}


def test_empty_table_and_stage(documents, nothing):
    assert exact_groups(nothing).count() == 0
    stay = drop_copies(documents)
    assert stay.columns == documents.columns
    # Equal: rows 1, 2, 2; the nulls and the empty text; both German ones; " \n " is one space.
    assert sorted(r.doc_id for r in stay.collect()) == [1, 3, 5, 6, 7, 8, 9, 10]
    assert drop_copies(nothing).count() == 0


def test_no_python_on_the_path(documents):
    plan = exact_groups(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
