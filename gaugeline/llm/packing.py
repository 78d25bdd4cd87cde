"""Packing documents into sequences along a space-filling curve.

Each document becomes token ids and a vector of hashed id counts. The vector is projected to three
dimensions, and its place on a Hilbert curve through that cube is the document's key: documents that use
like words lie near each other on the curve. Documents are range-sorted by key, running totals of their lengths give
each one its place in one long stream, and the stream is cut every 1024 tokens. What is left at the end is
cut into powers of two, so no sequence needs padding.

Ids come from one pass over the texts and are written; sorting and totals run over (key, length) only,
and the ids meet their place in one join.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import running, written

LIMIT = 1024
END = 0
# Words remembered by a task, in two generations; older ones are encoded anew.
REMEMBER = 120_000
BUCKETS, DIMS, BITS = 256, 3, 16
SEED = 20_240_607
# Documents held at a time by a task.
SLICE = 256
# Characters of texts whose words are looked up together, and of a first word that is remembered.
TOGETHER, LEAD = 1 << 15, 32
# A space that does not begin a piece of its own.
UNCUT = re.compile(r"\s ")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of whole texts, as 16- or 32-bit little-endian bytes.

    Byte-level pieces never cross from a character that isn't white space into a following space, so a text
    is cut there, and the ids of each word are remembered; texts with a space after white space are encoded whole.
    The words of many texts are looked up and learned at once.
    Words are encoded by a BPE of the same vocabulary (its ids are its merge ranks), which gives the tokenizer's
    ids; a text that holds a special token goes to the tokenizer itself.
    """

    def __init__(self, vocabulary: str) -> None:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.special = tuple(special)
        plain = {t: i for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items() if t not in special}
        ranks = {_as_bytes(t): i for t, i in plain.items()}
        self.bpe = tiktoken.Encoding("parts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.dtype = np.dtype("<u2" if self.size <= 65536 else "<u4")
        self.width = np.zeros(self.size, np.int64)
        for token, i in ranks.items():
            self.width[i] = len(token)
        # Ids of words after a space, without it, and of first words, by a space and the word. None ends in white space.
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        """Encode words in one text; each follows a space, and none ends in white space."""
        text = " " + " ".join(words)
        ids = self._ids(text)
        sizes = list(map(len, words if text.isascii() else map(str.encode, words)))
        ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum(np.array(sizes) + 1)) + 1
        raw, ends = ids.tobytes(), (ends * self.dtype.itemsize).tolist()
        self.new.update(zip(words, map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))

    def _ids(self, text: str) -> np.ndarray:
        return self.bpe.encode_to_numpy(text, disallowed_special=()).astype(self.dtype)

    def _raw(self, text: str) -> bytes:
        return self._ids(text).tobytes()

    def _lead(self, first: str) -> bytes:
        if len(first) > LEAD:
            return self._raw(first)
        ids = self.new.get(" " + first)
        if ids is None:
            ids = self.new[" " + first] = self._raw(first)
        return ids

    def _known(self, words: set[str]) -> set[str]:
        """Remembers all ``words`` but those that can't stand before a space, which it returns."""
        if len(self.new) > REMEMBER:
            self.old, self.new = self.new, {}
        words = words.difference(self.new)
        missing, uncut = list(words.difference(self.old)), set()
        again = words.difference(missing)
        self.new.update(zip(again, map(self.old.__getitem__, again), strict=True))
        if "" in words or UNCUT.search(" ".join([*missing, ""])):
            uncut = {w for w in missing if not w or w[-1].isspace()}
            missing = [w for w in missing if w not in uncut]
        if missing:
            self._learn(missing)
        return uncut

    def _together(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, self.dtype)] * len(texts)
        cut = []
        for i, text in enumerate(texts):
            first, *words = text.split(" ")
            if any(s in text for s in self.special):
                out[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)
            elif not words or not first or first[-1].isspace() or "  " in text:
                out[i] = self._ids(text)
            else:
                # What ends a text may end in white space.
                last = words.pop() if not words[-1] or words[-1][-1].isspace() else None
                cut.append((i, first, words, last))
        uncut = self._known(set(chain.from_iterable(words for _, _, words, _ in cut)))
        for i, first, words, last in cut:
            if uncut and not uncut.isdisjoint(words):
                out[i] = self._ids(texts[i])
                continue
            tail = b"" if last is None else self._raw(" " + last)
            out[i] = np.frombuffer(b"".join([self._lead(first), *map(self.new.__getitem__, words), tail]), self.dtype)
        return out

    def many(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text; words of neighbouring texts are looked up together."""
        begin, size = 0, 0
        for i, text in enumerate(texts):
            if i > begin and size + len(text) > TOGETHER:
                yield from self._together(texts[begin:i])
                begin, size = i, 0
            size += len(text)
        yield from self._together(texts[begin:])

    def __call__(self, text: str) -> np.ndarray:
        return self._together([text])[0]


def _as_bytes(token: str) -> bytes:
    """The bytes that a byte-level token stands for: printable Latin-1 as itself, the others from 256 on."""
    return bytes(_byte_letters()[c] for c in token)


@lru_cache(maxsize=1)
def _byte_letters() -> dict[str, int]:
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of integer points (rows of ``points``) on the Hilbert curve, by Skilling's transpose form."""
    x = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        low = q - 1
        for i in range(len(x)):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap if i else 0
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ turn) >> level) & 1)
    return key


class Curve:
    """Key of each document: hashed counts of ids, projected to a cube, along the curve."""

    def __init__(self, size: int) -> None:
        rng = np.random.default_rng(SEED)
        self.bucket = rng.integers(0, BUCKETS, size)
        self.sign = rng.choice([-1.0, 1.0], size)
        self.axes = rng.standard_normal((BUCKETS, DIMS))

    def keys(self, documents: list[np.ndarray]) -> np.ndarray:
        counts = np.zeros((len(documents), BUCKETS))
        for i, ids in enumerate(documents):
            if len(ids):
                counts[i] = np.bincount(self.bucket[ids], self.sign[ids], BUCKETS)
        counts = np.sign(counts) * np.log1p(np.abs(counts))
        norm = np.linalg.norm(counts, axis=1, keepdims=True)
        # Rounded, so that sums in another order give the same key.
        flat = np.round(counts / np.where(norm > 0, norm, 1) @ self.axes, 9)
        cells = np.floor((1 + np.tanh(0.8 * flat)) / 2 * (1 << BITS)).astype(np.int64)
        return hilbert(np.clip(cells, 0, (1 << BITS) - 1), BITS)


@lru_cache(maxsize=2)
def _tools(vocabulary: str) -> tuple[Encoder, Curve]:
    encoder = Encoder(vocabulary)
    return encoder, Curve(encoder.size)


def tokens(docs: DataFrame, doc_id: str, text: str, vocabulary: str) -> DataFrame:
    """``row, doc_id, curve, length, ids`` of each document, its end id included; written once."""
    kind = dict(docs.select(F.col(doc_id).alias("doc_id")).dtypes)["doc_id"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, curve = _tools(vocabulary)
        end = np.array([END], encoder.dtype)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                ids = list(encoder.many(part.column("text").to_pylist()))
                yield pa.record_batch(
                    {
                        "row": part.column("row"),
                        "doc_id": part.column("doc_id"),
                        "curve": pa.array(curve.keys(ids), pa.int64()),
                        "length": pa.array([len(i) + 1 for i in ids], pa.int64()),
                        "ids": pa.array([np.concatenate([i, end]).tobytes() for i in ids], pa.binary()),
                    }
                )

    source = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    encoded = source.mapInArrow(encode, f"row bigint, doc_id {kind}, curve bigint, length bigint, ids binary")
    return written(encoded, "tokens", "zstd")


def _tail(total: int, limit: int) -> list[int]:
    """Where the sequences of the rest begin: it is cut into powers of two, the largest first."""
    at, starts = total - total % limit, []
    for power in range(limit.bit_length() - 1, -1, -1):
        if (total % limit) >> power & 1:
            starts.append(at)
            at += 1 << power
    return starts


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, limit: int = LIMIT
) -> DataFrame:
    """Pieces of documents in sequences: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit ids. Each id of a document, the end id 0 included, lies in
    exactly one piece; a sequence holds ``limit`` ids, and the last ones a power of two each. Null texts count
    as empty: one piece with the end id. Documents of one key follow each other by id, null first; rows alike in all are
    interchangeable. Extra columns are not looked at; an empty table gives no piece.
    """
    table = tokens(docs, doc_id, text, vocabulary or default_vocabulary())
    wide = np.dtype("<u2") if _tools(vocabulary or default_vocabulary())[0].size <= 65536 else np.dtype("<u4")
    order = ["curve", "doc_id", "row"]
    placed = running(table.select("row", "doc_id", "curve", "length"), [], order, F.col("length"), "place").select("row", "place")
    total = table.agg(F.sum("length")).first()[0] or 0
    whole, tail = total - total % limit, np.array(_tail(total, limit), np.int64)
    kind = dict(table.dtypes)["doc_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                rows: list[tuple[int, ...]] = []
                pieces: list[bytes] = []
                for i, (place, raw) in enumerate(zip(part.column("place").to_pylist(), part.column("ids").to_pylist(), strict=True)):
                    ids = np.frombuffer(raw, wide).astype("<u4")
                    end = place + len(ids)
                    inner = range((place // limit + 1) * limit, min(end, whole + 1), limit)
                    edges = [place, *inner, *(t for t in tail.tolist() if place < t < end and t > whole), end]
                    for begin, stop in zip(edges, edges[1:], strict=False):
                        if begin < whole:
                            sequence, offset = divmod(begin, limit)
                        else:
                            k = int(np.searchsorted(tail, begin, "right")) - 1
                            sequence, offset = whole // limit + k, begin - int(tail[k])
                        rows.append((i, begin - place, stop - begin, len(ids), sequence, offset))
                        pieces.append(ids[begin - place : stop - place].tobytes())
                columns = np.array(rows, np.int64).reshape(-1, 6).T
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id").take(pa.array(columns[0])),
                        "start": pa.array(columns[1]),
                        "length": pa.array(columns[2]),
                        "ids": pa.array(pieces, pa.binary()),
                        "doc_tokens": pa.array(columns[3]),
                        "sequence_id": pa.array(columns[4]),
                        "offset": pa.array(columns[5]),
                    }
                )

    joined = table.select("row", "doc_id", "ids").join(placed, "row").select("doc_id", "ids", "place")
    return joined.mapInArrow(
        cut,
        f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint",
    )
