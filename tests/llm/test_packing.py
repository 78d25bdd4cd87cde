import numpy as np
import pytest

from gaugeline.llm.packing import _tail, default_vocabulary, hilbert, pack


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_vocabulary())


@pytest.mark.parametrize("limit", [64, 1024])
def test_pieces_are_the_documents(documents, tokenizer, limit):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    ids = [(i, (*tokenizer.encode(t or "", add_special_tokens=False).ids, 0)) for i, t in rows]
    pieces = pack(documents, limit=limit).collect()
    by_doc = {}
    for p in pieces:
        own = np.frombuffer(p.ids, "<u4").tolist()
        assert len(own) == p.length > 0
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, own))
    # Every id lies in one piece: alike documents count together.
    for (i, n), own in by_doc.items():
        alike = [d for d in ids if d[0] == i and len(d[1]) == n]
        assert sum(len(x) for _, x in own) == n * len(alike)
        assert all(any(list(d[1][s : s + len(x)]) == x for d in alike) for s, x in own)
    assert sum(p.length for p in pieces) == sum(len(d[1]) for d in ids)
    # Sequences are without gaps, and none needs padding.
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= limit and at & (at - 1) == 0


def test_empty_table(nothing):
    assert pack(nothing).count() == 0


def test_tail_is_powers_of_two():
    assert _tail(1024 * 3 + 13, 1024) == [3072, 3080, 3084]
    assert _tail(2048, 1024) == []


def test_hilbert_visits_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    key = hilbert(cells, 3)
    assert sorted(key) == list(range(512))
    assert np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1).max() == 1


def test_encoder_is_the_tokenizer(tokenizer):
    from gaugeline.llm import packing

    encoder = packing.Encoder(default_vocabulary())
    odd = ["a  b", " a", "a ", "a \n b", "x\n\n  y\t z", "  ", "", "a<|endoftext|>b c", "é  ñ　 x \x1c y", "it's 12 34's   !!  ?\r\n \n q", "one\n two"]
    odd += ["word%d other%d" % (i % 7, i) for i in range(50)]
    packing.REMEMBER, before = 20, packing.REMEMBER
    try:
        for text in odd * 2:
            assert encoder(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    finally:
        packing.REMEMBER = before


def test_words_of_many_texts_are_encoded_at_once(tokenizer, monkeypatch):
    from gaugeline.llm import packing

    class Counting:
        def __init__(self, bpe):
            self.bpe, self.calls = bpe, 0

        def __getattr__(self, name):
            self.calls += 1
            return getattr(self.bpe, name)

    encoder = packing.Encoder(default_vocabulary())
    plain = [f"the word{i} other{i % 7}.\nThe éñ{i}" for i in range(200)]
    encoder.bpe = Counting(encoder.bpe)
    got = list(encoder.many(plain))
    assert encoder.bpe.calls < 10
    odd = ["a  b", " a", "a ", "a \n b", "b\n", "b\n c", "x\n\n  y\t z", "", "q r ", "q r\n", "q r\n s", "a<|endoftext|>b c", "é ñ　 x", "r" * 40 + " s"]
    monkeypatch.setattr(packing, "REMEMBER", 20)
    monkeypatch.setattr(packing, "TOGETHER", 100)
    got += encoder.many(plain + odd * 3)
    for text, ids in zip(plain + plain + odd * 3, got, strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
