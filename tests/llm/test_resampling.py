import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from gaugeline.llm import resampling as R

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, longest):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOW))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, longest, buckets, draw, least):
    def counted(texts):
        out = [0] * buckets
        for text in texts:
            for f in features(text, longest)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = counted([text for _, text in docs]), counted(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)]
    rows = []
    for doc_id, text in docs:
        words, found = features(text, longest)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    wide = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], -1 if r[0] is None else r[0]))
    drawn = wide[: len(wide) * draw[0] // draw[1]]
    return sorted((*r, None) for r in rows if r not in drawn), [(*r, i) for i, r in enumerate(drawn, 1)]


@pytest.mark.parametrize("longest", [1, 3])
def test_draws_what_brute_force_draws(spark, longest):
    rng = np.random.default_rng(longest)
    vocabulary = ["Alpha", "beta9", "γάμμα", "漢字", "x", "don't", "a-b", "É", "Z\x7fz", "_"]
    texts = [" ".join(rng.choice(vocabulary, int(rng.integers(0, 30)))) for _ in range(120)]
    docs = [*enumerate(texts), (200, None), (201, ""), (202, "\n\x00 !")]
    target = [*texts[:5], None, "x x x"]
    left = spark.createDataFrame(docs, "doc_id int, text string").repartition(5)
    got = R.resampled(left, spark.createDataFrame([(t,) for t in target], "text string"), longest=longest, buckets=64, least_words=4).collect()
    rest, drawn = brute(docs, target, longest, 64, R.DRAW, 4)
    assert sorted((tuple(r) for r in got if r.rank), key=lambda r: r[5]) == drawn
    assert sorted(tuple(r) for r in got if not r.rank) == rest


def test_words_of_one_text_only():
    found = R.Reader(longest=2)(["a b", "", "c", "d e f"])
    assert found.words.tolist() == [2, 0, 1, 3]
    pairs = [zlib.crc32(x) % R.BUCKETS for x in (b"a b", b"d e", b"e f")]
    assert found.bucket[6:].tolist() == pairs and found.text[6:].tolist() == [0, 3, 3]


def test_forgets_words(monkeypatch):
    monkeypatch.setattr(R, "REMEMBER", 3)
    reader = R.Reader()
    for i in range(20):
        assert reader([f"w{i} w{i + 1} same"]).bucket.tolist() == [zlib.crc32(w) % R.BUCKETS for w in (b"w%d" % i, b"w%d" % (i + 1), b"same")]


def test_odd_rows(documents, nothing, spark):
    target = spark.createDataFrame([("the cat and the dog",)], "text string")
    got = R.resampled(documents, target, draw=(1, 2), least_words=1).collect()
    assert len(got) == documents.count()
    wide = [r for r in got if r.n_words]
    drawn = sorted((r for r in got if r.rank), key=lambda r: r.rank)
    assert [r.rank for r in drawn] == list(range(1, len(wide) // 2 + 1))
    assert all(a.score >= b.score for a, b in zip(drawn, drawn[1:], strict=False))
    assert {r.weight for r in got if not r.n_words} == {0}
    assert R.resampled(nothing, target).count() == 0
    alone = R.resampled(documents, target.limit(0)).collect()
    assert len(alone) == documents.count()
