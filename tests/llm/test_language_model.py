import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import context_tree as tree
from gaugeline.llm import language_model
from gaugeline.llm.queries import op11_language_model

DEPTH = 3


def kt(zeros, ones):
    """Krichevsky-Trofimov, one symbol after the other."""
    total, n = 0.0, [0, 0]
    for bit, times in ((0, zeros), (1, ones)):
        for _ in range(times):
            total += math.log((n[bit] + 0.5) / (sum(n) + 1))
            n[bit] += 1
    return total


class Brute:
    """Counts of every context and node in a dictionary; weighted probabilities by recursion."""

    def __init__(self, texts, depth):
        self.depth, self.count = depth, Counter()
        for text in texts:
            for context, node, bit in self.decisions(text):
                self.add(context, node, bit)

    def decisions(self, text):
        symbols = bytes([tree.END]) * self.depth + text + bytes([tree.END])
        for i in range(self.depth, len(symbols)):
            node = 1
            for k in range(7, -1, -1):
                bit = symbols[i] >> k & 1
                yield symbols[i - self.depth : i][::-1], node, bit
                node = 2 * node + bit

    def add(self, context, node, bit, times=1):
        for d in range(self.depth + 1):
            self.count[context[:d], node, bit] += times

    def weighted(self, context, node):
        own = kt(self.count[context, node, 0], self.count[context, node, 1])
        if len(context) == self.depth:
            return own
        children = {c for (c, n, _), times in self.count.items() if n == node and times and len(c) == len(context) + 1 and c.startswith(context)}
        return np.logaddexp(own, sum(self.weighted(c, node) for c in children)) - math.log(2)

    def score(self, text):
        """Each decision's probability is what the root's weighted probability gains by it."""
        total = 0.0
        for context, node, bit in self.decisions(text):
            before = self.weighted(b"", node)
            self.add(context, node, bit)
            total += self.weighted(b"", node) - before
            self.add(context, node, bit, -1)
        return total / math.log(10)


TRAIN = ["abab abab", "abba", None, "", "ab ab ab"]
OTHER = ["abab", "zé", "", None, "AB ba"]


@pytest.fixture(scope="module")
def small(spark):
    rows = [(i, t, True) for i, t in enumerate(TRAIN)] + [(10 + i, t, False) for i, t in enumerate(OTHER)]
    return spark.createDataFrame(rows, "doc_id int, text string, known boolean").repartition(3)


def test_scores_are_the_context_trees(small):
    brute = Brute([(t or "").encode().lower() for t in TRAIN], DEPTH)
    for block in (1, 1 << 20):
        got = {r.doc_id: r for r in language_model.scored(small, F.col("known"), depth=DEPTH, block_bytes=block).collect()}
        assert len(got) == len(TRAIN) + len(OTHER)
        for i, text in [*enumerate(TRAIN), *enumerate(OTHER, 10)]:
            raw = (text or "").encode().lower()
            assert got[i].score == pytest.approx(brute.score(raw), abs=1e-9)
            assert got[i].bits_per_byte == pytest.approx(-got[i].score / math.log10(2) / (len(raw) + 1))


def test_probabilities_of_all_bytes_sum_to_one():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.choice(list(b"ab c"), 40).tolist()) for _ in range(5)]
    found, _ = tree.text_grams(texts, DEPTH)
    contexts = np.append(np.unique(found >> 8), 0x010203)
    every = np.unique(np.concatenate([found, (contexts[:, None] << 8 | np.arange(256)).ravel()]))
    count = np.zeros(len(every), np.int64)
    key, n = np.unique(found, return_counts=True)
    count[np.searchsorted(every, key)] = n
    total = np.zeros(len(contexts))
    chances = tree.mixed_chances(tree.upward(every, count, DEPTH, 0)).prod(0)
    np.add.at(total, np.searchsorted(np.sort(contexts), every >> 8), chances)
    assert total == pytest.approx(np.ones(len(contexts)))


def test_base_scores_are_the_word_models(small):
    got = {r.doc_id: r for r in language_model.scored(small, F.col("known"), depth=DEPTH).collect()}
    count = Counter(w for t in TRAIN for w in [*(t or "").lower().split(), None])
    n, v = sum(count.values()), len(count)
    for i, text in enumerate(OTHER, 10):
        tokens = [*(text or "").lower().split(), None]
        assert (got[i].n_tokens, got[i].train_tokens) == (len(tokens), n)
        assert got[i].n_known == sum(count[w] > 0 for w in tokens)
        assert got[i].base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens))


def test_odd_rows(documents, nothing):
    known = F.col("lang").isNotNull()
    got = language_model.scored(documents, known).collect()
    assert len(got) == documents.count()
    repeated = [r for r in got if r.doc_id == 2]
    assert len(repeated) == 2 and repeated[0] == repeated[1]
    assert all(r.score < 0 and r.n_tokens >= 1 for r in got)
    assert language_model.scored(nothing, known).count() == 0
    unlearned = language_model.scored(documents, F.lit(None).cast("boolean")).collect()
    assert all(r.bits_per_byte == pytest.approx(8) and r.n_known == 0 and r.train_tokens == 0 for r in unlearned)
    assert all(r.base_score == 0 for r in unlearned)


def test_beats_the_word_model_on_held_out_texts(spark):
    got = op11_language_model(spark, "/root/testdata/sf0.1").filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_a_block_holds_little_beside_its_distinct_grams():
    import tracemalloc

    rng = np.random.default_rng(2)
    parts = [[rng.integers(97, 123, 1 << 18).astype(np.uint8).tobytes()] for _ in range(16)]
    language_model.WAITING, before = 1 << 18, getattr(language_model, "WAITING", None)
    tracemalloc.start()
    try:
        block = language_model._Block(DEPTH)
        for part in parts:
            block.add(part, [True])
        found = [r for r in block.rows(0) if r.column("gram").null_count == 0]
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        language_model.WAITING = before
    every, _ = tree.text_grams([t for part in parts for t in part], DEPTH)
    key, count = np.unique(every, return_counts=True)
    assert np.concatenate([r.column("gram").to_numpy() for r in found]).tolist() == key.tolist()
    assert np.concatenate([r.column("n").to_numpy() for r in found]).tolist() == count.tolist()
    # Sixteen parts of 256 Ki grams, about 170,000 distinct ones each, make 26**4 in all.
    assert most < 100 << 20


def test_rows_are_told_in_few_packed_pieces(spark):
    rows = spark.range(5000).selectExpr("id % 7 AS block", "id AS gram", "id / 3D AS value").repartition(2)
    pieces = language_model._by_block(rows).collect()
    assert len(pieces) == 14
    for block in range(7):
        parts = language_model.pa.chunked_array([[p.rows for p in pieces if p.block == block]])
        key, value = language_model._gram_table(parts)
        assert key.tolist() == list(range(block, 5000, 7))
        assert value.tolist() == pytest.approx((key / 3).tolist())
