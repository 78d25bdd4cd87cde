import pytest

from gaugeline.llm import token_counts as T


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer, models, normalizers

    model = Tokenizer(models.Unigram(T.pieces(T.default_vocabulary()), unk_id=0, byte_fallback=True))
    model.normalizer = normalizers.Sequence([normalizers.Prepend(T.MARK), normalizers.Replace(" ", T.MARK)])
    return model


def test_counts_are_the_tokenizers(spark, documents, nothing, tokenizer):
    texts = ["a  b", " a", "a ", "  ", "", None, "漢字 x😀😀y", "▁a ▁ b", "<s> <0x41></s>", "a\n b\n\n", "a" * 300, " " * 37, "▁▁ ▁"]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r.n_tokens for r in T.token_counts(df).collect()}
    assert got == {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
    assert T.token_counts(documents).count() == documents.count()
    assert T.token_counts(nothing).count() == 0


def test_ties_and_forgotten_words(tokenizer, monkeypatch):
    from tokenizers import Tokenizer, models

    vocabulary = [("<unk>", 0.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("b", -2.0), ("ab", -3.0), (T.MARK, -1.0), (T.MARK + "a", -2.0)]
    plain = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=False))
    counter = T.Counter(vocabulary)
    for n in range(1, 7):
        for code in range(2**n):
            word = T.MARK + "".join("ab"[code >> i & 1] for i in range(n))
            assert counter.pieces_of(word) == len(plain.encode(word).ids), word
    monkeypatch.setattr(T, "REMEMBER", 6)
    full = T.Counter(T.pieces(T.default_vocabulary()))
    for i in range(60):
        text = f"word{i % 9} other{i} end"
        assert full(text) == len(tokenizer.encode(text).ids)


def test_trained_vocabularies_run_over_the_whole_text():
    """Log probabilities, and pieces that hold spaces inside."""
    import random

    from tokenizers import Tokenizer, models, normalizers

    draw = random.Random(4)
    pieces = {T.MARK, "a", "b", "c", T.MARK + "a", "a" + T.MARK + "b", "ab" + T.MARK}
    pieces |= {"".join(draw.choice(f"abc{T.MARK}") for _ in range(draw.randint(2, 5))) for _ in range(60)}
    scores = {p: -draw.random() * 9 - 0.1 for p in sorted(pieces)}
    vocabulary = [("<unk>", 0.0), *scores.items(), *[(f"<0x{b:02X}>", -30.0) for b in range(256)]]
    model = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    model.normalizer = normalizers.Sequence([normalizers.Prepend(T.MARK), normalizers.Replace(" ", T.MARK)])
    texts = ["".join(draw.choice("abc  é") for _ in range(draw.randint(0, 60))) for _ in range(300)] + ["ab " * 2000, None]
    counter = T.Counter(vocabulary)
    assert not counter.by_word and T.Counter(T.pieces(T.default_vocabulary())).by_word
    want = [len(model.encode(t or "").ids) for t in texts]
    assert [counter(t or "") for t in texts] == want
