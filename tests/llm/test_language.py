import itertools

import numpy as np
import pytest

from gaugeline.llm import language
from gaugeline.llm.queries import op1_language

EN = "the cat and the dog were in the house with a thing that they had "
DE = "der Hund und die Katze sind nicht im Haus weil sie schlafen und "
RU = "кошка и собака не были в доме потому что "


@pytest.fixture(scope="module")
def model(spark):
    rows = [(EN * 3, "en"), (DE * 3, "de"), (RU * 3, "ru"), (None, "en"), ("x", None)]
    return language.fit(spark.createDataFrame(rows, "text string, lang string"))


def test_path_is_the_best_of_all(model):
    rng = np.random.default_rng(2)
    for sizes in ([3, 1, 7], [1], [5, 5]):
        text = np.repeat(np.arange(len(sizes)), sizes)
        scores = rng.normal(0, 3, (len(text), 3)).astype(np.float32)
        language.CHUNK, before = 2, language.CHUNK
        try:
            path = language.viterbi(scores, text, 2.0)
        finally:
            language.CHUNK = before

        def worth(states, own):
            return own[range(len(own)), list(states)].sum() - 2.0 * sum(a != b for a, b in itertools.pairwise(states))

        for t in range(len(sizes)):
            own = scores[text == t].astype(np.float64)
            best = max(worth(s, own) for s in itertools.product(range(3), repeat=len(own)))
            assert worth(path[text == t], own) == pytest.approx(best)


@pytest.mark.parametrize("states", [40, 200])
def test_path_of_many_languages(states):
    """Against a plain Viterbi, over texts of very different lengths and a long one alone."""

    def plain(own):
        value, back = own[0].copy(), []
        for row in own[1:]:
            best = int(value.argmax())
            stay = value >= value[best] - 3.0
            back.append(np.where(stay, np.arange(states), best))
            value = np.where(stay, value, value[best] - 3.0) + row
        path = [int(value.argmax())]
        for step in reversed(back):
            path.append(int(step[path[-1]]))
        return path[::-1]

    rng = np.random.default_rng(states)
    for sizes in ([1, 300, 20], [1500]):
        text = np.repeat(np.arange(len(sizes)), sizes)
        scores = rng.normal(0, 2, (len(text), states)).astype(np.float32)
        scores[len(text) // 2 :, states - 1] += 2
        path = language.viterbi(scores, text, 3.0)
        for t in range(len(sizes)):
            assert path[text == t].tolist() == plain(scores[text == t].astype(np.float64))
        assert path.max() == states - 1 and path.min() >= 0


def test_each_language_is_sampled_by_itself(spark):
    bounds = language.sample_bounds({"huge": 10**10, "small": 1000, "none": 0}, 2000)
    assert bounds["small"] == bounds["none"] == 2**63 - 1
    assert bounds["huge"] / 2**63 * 10**10 == pytest.approx(2000)
    rows = [(f"{EN} {i}", "en") for i in range(400)] + [(DE, "de")] * 3
    small = language.fit(spark.createDataFrame(rows, "text string, lang string"), sample=40)
    assert small.languages == ["de", "en"]


def test_spans_of_mixed_text(spark, model):
    text = EN + DE + RU
    row = language.label(spark.createDataFrame([(1, text)], "doc_id int, text string"), model).first()
    assert [s.lang for s in row.spans] == ["en", "de", "ru"]
    assert text[row.spans[1].start : row.spans[1].end].startswith("der Hund")
    assert text[row.spans[2].start : row.spans[2].end].startswith("кошка")
    assert 0 < row.score < 1


def test_odd_rows(documents, nothing, model, spark):
    got = language.label(documents, model).collect()
    assert len(got) == documents.count()
    und = [r for r in got if r.lang_pred == "und"]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in und) == [(False, 3), (False, 4), (False, 5), (False, 9), (True, 0)]
    assert all(r.score == 0 and not r.spans for r in und)
    assert {r.lang_pred for r in got} <= {"en", "de", "ru", "und"}
    assert language.label(nothing, model).count() == 0
    empty = language.fit(nothing)
    assert {r.lang_pred for r in language.label(documents, empty).collect()} == {"und"}


def test_held_out_accuracy(spark):
    got = op1_language(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
