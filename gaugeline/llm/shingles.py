"""Hashes of words and of runs of words for many texts at once (numpy; runs inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Characters of text that a task works on at a time (one text at least).
SLICE = 500_000
# Rows of a batch whose texts are held as Python strings at a time.
ROWS_HELD = 256
_BASE = 0x9E3779B97F4A7C15 | 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit value for each one given (the finaliser of splitmix64)."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            one = np.ones(1, np.uint64)
            inverse = pow(_BASE, -1, 1 << 64)
            self.up = np.concatenate([one, np.full(size - 1, _BASE, np.uint64)]).cumprod(dtype=np.uint64)
            self.down = np.concatenate([one, np.full(size - 1, inverse, np.uint64)]).cumprod(dtype=np.uint64)
        return self.up, self.down


_powers = _Powers()


@dataclass
class WordHashes:
    """Per word: its hash, its text, and where it begins and ends in it (code points)."""

    hash: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray


def word_hashes(texts: list[str], fold: bool = False) -> WordHashes:
    """Words are runs without space, tab, line and page breaks. ``fold`` hashes lower-case letters."""
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]]).astype(np.int64)
    joined = " ".join(texts)
    if fold:
        low = joined.lower()
        # A few letters change their number of characters; then only the others are folded.
        joined = low if len(low) == len(joined) else "".join(c.lower() if len(c.lower()) == 1 else c for c in joined)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = (points == 32) | ((points >= 9) & (points <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    up, down = _powers.get(len(points) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], dtype=np.uint64)])
    hashes = mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    text = np.searchsorted(begins, start, "right") - 1
    return WordHashes(hashes, text, start - begins[text], end - begins[text])


def shingles(words: WordHashes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and first word of each run of ``n`` words; a text of fewer words is one run."""
    count = len(words.hash)
    if not count:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none
    sizes = np.bincount(words.text)
    left = np.cumsum(sizes)[words.text] - np.arange(count)
    first = np.append(True, words.text[1:] != words.text[:-1])
    at = np.flatnonzero((left >= n) | (first & (left < n)))
    value = np.zeros(len(at), np.uint64)
    for i in range(n):
        inside = left[at] > i
        word = words.hash[np.minimum(at + i, count - 1)]
        value = mix64(value * np.uint64(0xD1342543DE82EF95) + np.where(inside, word, np.uint64(i)))
    return value, words.text[at], at


def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of a few rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_HELD):
            yield batch.slice(at, ROWS_HELD)


def slices(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """The texts in groups of bounded size, with the place of the first one of each."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > SLICE:
            yield begin, texts[begin:i]
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, texts[begin:]
