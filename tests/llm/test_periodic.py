import itertools

import numpy as np
import pytest

from gaugeline.llm import periodic as P


def brute(words, least, repeats):
    """Every stretch of every period, the ones with a smaller period left out."""
    n, found = len(words), []
    for q in range(1, n):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, repeats * q):
                found.append((i, j - i + q, q))
            i = max(j, i + 1)
    whole = [r for r in found if not any(o[2] < r[2] and o[0] <= r[0] and o[0] + o[1] >= r[0] + r[1] for o in found)]
    return sorted(whole, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize(("least", "repeats"), [(6, 4), (2, 2), (4, 3), (1, 2)])
def test_runs_of_all_short_texts(least, repeats):
    for n in range(0, 11):
        for words in itertools.product("ab", repeat=n):
            assert P.runs(list(words), least, repeats) == brute(words, least, repeats), words


def test_runs_of_random_texts():
    rng = np.random.default_rng(3)
    for _ in range(300):
        words = rng.integers(0, 3, int(rng.integers(5, 60))).tolist()
        for _ in range(2):
            a, p = int(rng.integers(0, len(words))), int(rng.integers(1, 6))
            words[a:a] = words[a : a + p] * int(rng.integers(2, 8))
        for least, repeats in ((6, 4), (3, 2)):
            assert P.runs(words, least, repeats) == brute(words, least, repeats)


def test_best_and_collapsed():
    words = "x a b a b a b a b y c c c c c c".split()
    found = P.runs(words)
    assert found == [(1, 8, 2), (10, 6, 1)]
    assert P.strongest(found) == (10, 6, 1)
    assert P.strongest([(0, 8, 2), (9, 12, 3)]) == (0, 8, 2)
    assert P.strongest([]) is None
    assert P.collapsed(words, found) == "x a b y c".split()


def test_filter_never_loses_a_text():
    rng = np.random.default_rng(5)
    texts = [[b"%d" % x for x in rng.integers(0, 4, int(rng.integers(0, 40)))] for _ in range(200)]
    passed = P.with_repeats(texts, 5)
    for text, some in zip(texts, passed, strict=True):
        five = [tuple(text[i : i + 5]) for i in range(len(text) - 4)]
        assert some == (len(set(five)) < len(five))
    assert not P.with_repeats([[], [b"a"]], 5).any()


def test_trial_texts():
    words = [str(i) for i in range(100)]
    assert P.looped(words, 7) == words
    h = 20 * 10
    a, p = 20, 1 + 80 // (3 + 20 % 8)
    assert P.looped(words, h) == [words[i if i < a else a + (i - a) % p] for i in range(100)]
    assert P.looped([], h) == []
    assert P.id_hash(None) == 0 and P.id_hash(12) == 1330857165


def test_long_texts_of_many_runs(spark):
    same = "word " * 200_000
    blocks = " ".join(f"k{i} " + "a " * (5 + i * 7919 % 60) for i in range(3000))
    rng = np.random.default_rng(9)
    binary = " ".join("ab"[i] for i in rng.integers(0, 2, 60_000))
    rows = {r.doc_id: r for r in P.periodic_runs(spark.createDataFrame([(1, same), (2, blocks), (3, binary)], "doc_id int, text string")).collect()}
    assert [tuple(r) for r in rows[1].runs] == [(0, 200_000, 1)] and rows[1].text == "word"
    assert len(rows[2].runs) == sum(5 + i * 7919 % 60 >= 6 for i in range(3000))
    assert rows[2].text.startswith("k0 a a a a a k1 a k2 a")
    for start, length, q in rows[3].runs:
        part = binary.split()[start : start + length]
        assert part[q:] == part[:-q] and length >= max(6, 4 * q)


def test_odd_rows(documents, nothing):
    got = P.periodic_runs(documents).collect()
    assert len(got) == documents.count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[6].best.period == 4 and by_id[6].text == "the thing and that"
    assert by_id[7].text == "the thing and that end"
    assert by_id[3].n_words == by_id[4].n_words == by_id[5].n_words == 0
    assert by_id[3].best is None and by_id[3].runs == [] and by_id[3].text == ""
    assert by_id[2].text == "the cat sat on the mat and the dog sat too"
    assert P.periodic_runs(nothing).count() == 0
