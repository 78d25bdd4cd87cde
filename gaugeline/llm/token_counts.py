"""Token counts of a unigram tokenizer, by Viterbi that carries only the best score and its number of pieces.

An Aho-Corasick automaton of the vocabulary lists the pieces that end at each character, the longest first; dynamic
programming keeps the best score of each prefix and the number of pieces that give it. Ties go to
the piece that begins first, as in the tokenizer, and a character that is no piece costs the lowest score less
ten and gives a token per byte.

Where no piece reaches over the border between a character and a following space, texts fall apart into words there. If also
scores are whole numbers, whose sums are exact, a word's count doesn't depend on what stands before it and is
remembered by the task, in two generations of bounded size. Other vocabularies, such as log probabilities of a trained
one, are run over the whole text, in the tokenizer's own order of sums.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The mark of a space in pieces, and what a character without a piece costs beyond the lowest score.
MARK = "▁"
UNKNOWN_COST = 10.0
REMEMBER = 500_000
# A space that does not begin a word of its own.
UNCUT = re.compile(f"[ {MARK}] ")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def pieces(vocabulary: str) -> list[tuple[str, float]]:
    """The vocabulary's pieces and scores, in order of their ids; the first one is the unknown piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    return [(model.id_to_piece(i), float(model.get_score(i))) for i in range(model.get_piece_size())]


class Counter:
    def __init__(self, vocabulary: list[tuple[str, float]]) -> None:
        self.automaton = ahocorasick.Automaton()
        scores: dict[str, float] = {}
        for piece, score in vocabulary:
            # Of equal pieces the last one counts.
            scores[piece] = score
        self.by_word = all(score == int(score) and MARK not in piece.lstrip(MARK) for piece, score in scores.items())
        for piece, score in scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_COST
        self.new: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def pieces_of(self, word: str) -> int:
        """Number of tokens of a word in which spaces are marked."""
        n = len(word)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        done = 0
        score, number, single = None, 0, False

        def close(end: int) -> None:
            nonlocal score, number, single
            if not single:
                other = best[end] + self.unknown
                if score is None or other > score:
                    score, number = other, count[end] + len(word[end].encode("utf-8", "surrogatepass"))
            best[end + 1], count[end + 1] = score, number
            score, number, single = None, 0, False

        for end, (length, value) in self.automaton.iter(word):
            while done < end:
                close(done)
                done += 1
            begin = end + 1 - length
            reached = best[begin] + value
            if score is None or reached > score:
                score, number = reached, count[begin] + 1
            single = single or length == 1
        while done < n:
            close(done)
            done += 1
        return count[n]

    def _word(self, word: str) -> int:
        found = self.old.get(word)
        if found is None:
            found = self.pieces_of(MARK + word.replace(" ", MARK))
        if len(word) <= 64:
            if len(self.new) >= REMEMBER // 2:
                self.old, self.new = self.new, {}
            self.new[word] = found
        return found

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        if not self.by_word:
            return self.pieces_of(MARK + text.replace(" ", MARK))
        words = text.split(" ")
        if not words[0] or UNCUT.search(text):
            words = _merged(words)
        found = list(map(self.new.get, words))
        if None in found:
            found = [f if f is not None else self._word(w) for w, f in zip(words, found, strict=True)]
        return sum(found)


def _merged(parts: list[str]) -> list[str]:
    """Words that are cut only where the character before the space is no space or mark."""
    words = [parts[0]]
    for part in parts[1:]:
        if words[-1] and words[-1][-1] not in (" ", MARK):
            words.append(part)
        else:
            words[-1] += " " + part
    return words


@lru_cache(maxsize=2)
def _counter(vocabulary: str) -> Counter:
    return Counter(pieces(vocabulary))


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``doc_id, n_tokens`` of each row's whole text; null and empty texts have none.

    Counts are those of the unigram model over the pieces and scores of ``vocabulary``, with a mark for each space
    and before the text, and bytes for unknown characters. Repeated rows are counted each, an empty table gives no rows; extra
    columns are not looked at. A very long text is held whole by one task; so are the best scores of its prefixes, unless the
    vocabulary lets it fall apart into words.
    """
    path = vocabulary or default_vocabulary()
    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            counts = [counter(t or "") for t in batch.column("text").to_pylist()]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64())})

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, f"doc_id {kind}, n_tokens bigint")
