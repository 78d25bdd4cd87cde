"""Language of texts: spans of words by Viterbi over per-word scores.

A word is a run of letters. The script of its first letter narrows the languages it may belong to (those
seen with that script when fitted), and hashed letter trigrams give it a log-likelihood per language. The best path over
a document's words, with a penalty for each switch, labels spans of mixed text; the language with most letters
on that path is the document's.

The model is fitted on a bounded sample of labelled rows: counts of trigrams per language, summed by Spark.
Paths are exact at any length: documents are cut into chunks of words, all chunks of a batch advance
together as transfers between languages, and are then joined per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.shingles import held

BUCKETS = 1 << 15
# Labelled texts of each language that a model is fitted on, about.
SAMPLE = 2_000
# Cost of a change of language, in nats.
SWITCH = 8.0
CHUNK = 128
# Languages up to which a task works on parts of full size; beyond, parts shrink with the square of their number.
FEW = 16
# Characters of text that a task works on at a time (one text at least).
SLICE = 500_000
UNKNOWN = "und"

# Main Unicode ranges of scripts.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: the folded letter or 0 if it is none, and the script's number (0: another)."""
    points = [chr(c) if not 0xD800 <= c <= 0xDFFF else " " for c in range(0x110000)]
    fold = np.zeros(len(points), np.uint32)
    for i, c in enumerate(points):
        if c.isalpha():
            low = c.lower()
            fold[i] = ord(low) if len(low) == 1 else i
    script = np.zeros(len(points), np.int8)
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            script[first : last + 1] = number
    return fold, script


@dataclass
class Words:
    """Words of several texts: trigram buckets per letter, and per word its first letter and text."""

    bucket: np.ndarray
    first: np.ndarray
    letters: np.ndarray
    text: np.ndarray
    script: np.ndarray
    start: np.ndarray
    end: np.ndarray


def find_words(texts: list[str]) -> Words:
    fold, script = _letters()
    # A space between texts ends words.
    joined = np.frombuffer(" ".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    folded = np.concatenate([[np.uint32(0)], fold[joined], [np.uint32(0)]])
    at = np.flatnonzero(folded)
    before, here, after = folded[at - 1], folded[at], folded[at + 1] if len(at) else folded[:0]
    mixed = before * np.uint32(0x9E3779B1) ^ here * np.uint32(0x85EBCA77) ^ after * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    bucket = (mixed * np.uint32(0x27D4EB2F)) >> np.uint32(32 - 15)
    first = np.flatnonzero(before == 0)
    start = at[first] - 1
    letters = np.diff(np.append(first, len(at)))
    text = np.searchsorted(begins, start, "right") - 1
    return Words(bucket, first, letters, text, script[joined[start]], start - begins[text], start + letters - begins[text])


@dataclass
class Model:
    """``score[bucket, language]`` in nats, and which languages were seen with which script."""

    languages: list[str]
    score: np.ndarray
    allowed: np.ndarray

    def word_scores(self, words: Words) -> np.ndarray:
        if not len(words.first):
            return np.zeros((0, len(self.languages)), np.float32)
        sums = np.add.reduceat(self.score[words.bucket], words.first, axis=0)
        return np.where(self.allowed[words.script], sums, np.float32(-1e9))


def sample_bounds(rows: dict[str, int], sample: int) -> dict[str, int]:
    """For each language of so many rows the hash of 63 bits below which a text is chosen."""
    return {lang: (2**63 - 1) * sample // max(n, sample, 1) for lang, n in rows.items()}


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """Model of the languages in column ``lang``; rows without text or language teach nothing.

    Of each language about ``sample`` rows are used, chosen by a hash of their text, equal ones once; all if there are fewer.
    So every labelled language is learned at any size of the table. An empty table gives a model of no languages.
    """
    rows = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    bounds = sample_bounds(dict(tuple(r) for r in rows.groupBy("lang").count().collect()), sample)
    if not bounds:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS) + 1, 0), bool))
    bound = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])[F.col("lang")]
    rows = rows.filter(F.shiftrightunsigned(F.xxhash64("text"), 1) <= bound).dropDuplicates(["lang", "text"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in held(batches):
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for name in set(langs):
                seen, scripts = sums.setdefault(name, (np.zeros(BUCKETS, np.int64), np.zeros(len(SCRIPTS) + 1, np.int64)))
                for own in _slices([t for t, n in zip(texts, langs, strict=True) if n == name]):
                    words = find_words(own)
                    seen += np.bincount(words.bucket, minlength=BUCKETS)
                    scripts += np.bincount(words.script, words.letters, len(scripts)).astype(np.int64)
        for name, (seen, scripts) in sums.items():
            # Scripts are told apart from buckets by negative numbers.
            slots = np.concatenate([np.flatnonzero(seen), -1 - np.flatnonzero(scripts)])
            counts = np.concatenate([seen[seen > 0], scripts[scripts > 0]])
            yield pa.record_batch({"lang": pa.array([name] * len(slots)), "slot": pa.array(slots), "n": pa.array(counts)})

    counted = rows.mapInArrow(count, "lang string, slot bigint, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    # At most one row per language and bucket: the model itself.
    table = counted.toPandas()
    languages = sorted(table["lang"].unique())
    scores = np.zeros((BUCKETS, len(languages)))
    allowed = np.zeros((len(SCRIPTS) + 1, len(languages)), bool)
    for i, name in enumerate(languages):
        own = table[table["lang"] == name]
        slot, n = own["slot"].to_numpy(), own["n"].to_numpy()
        scores[slot[slot >= 0], i] = n[slot >= 0]
        letters = np.zeros(len(SCRIPTS) + 1)
        letters[-1 - slot[slot < 0]] = n[slot < 0]
        allowed[:, i] = letters >= 0.01 * max(letters.sum(), 1)
    logs = np.log((scores + 0.5) / (scores.sum(0) + 0.5 * BUCKETS))
    # A script seen with no language excludes none.
    allowed[~allowed.any(1)] = True
    return Model(languages, logs.astype(np.float32), allowed)


def viterbi(scores: np.ndarray, text: np.ndarray, switch: float) -> np.ndarray:
    """State of each word on the best path of its text. ``text`` is the word's text, ascending."""
    words, states = scores.shape
    if not words:
        return np.zeros(0, np.int64)
    begins = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    sizes = np.diff(np.append(begins, words))
    # With many states chunks grow as far as all texts fill them: transfers cost the square of the states for each.
    width = CHUNK * int(np.clip(sizes.min() // CHUNK, 1, max(1, states * states // FEW**2)))
    chunks = -(-sizes // width)
    first = np.concatenate([[0], np.cumsum(chunks)[:-1]])
    total = int(chunks.sum())
    # Words without scores fill the last chunk of a text; they change nothing.
    of = np.repeat(np.arange(len(begins)), sizes)
    place = np.arange(words) - begins[of]
    cell = (first[of] + place // width) * width + place % width
    padded = np.zeros((total * width, states), np.float64)
    padded[cell] = scores
    padded = padded.reshape(total, width, states)
    # 1. What a chunk does to any state before it.
    transfer = np.full((total, states, states), -np.inf)
    transfer[:, range(states), range(states)] = 0
    for t in range(width):
        transfer = np.maximum(transfer, transfer.max(2, keepdims=True) - switch) + padded[:, t, None, :]
    # 2. Best scores before each chunk, along the chunks of every text.
    entry = np.zeros((total, states))
    deep = int(chunks.max())
    for k in range(deep - 1):
        here = first[chunks > k + 1] + k
        entry[here + 1] = (entry[here][:, :, None] + transfer[here]).max(1)
    # 3. Where each state comes from.
    back = np.empty((width, total, states), np.int16)
    value, own = entry.copy(), np.arange(states)
    for t in range(width):
        best = value.argmax(1)
        moved = np.take_along_axis(value, best[:, None], 1) - switch
        stay = value >= moved
        back[t] = np.where(stay, own, best[:, None])
        value = np.where(stay, value, moved) + padded[:, t, :]
    # 4. From the end: the state before a chunk for each state after it, then along the chunks, then within.
    origin = np.tile(own, (total, 1))
    for t in range(width - 1, -1, -1):
        origin = np.take_along_axis(back[t], origin, 1)
    after = np.empty(total, np.int64)
    last = first + chunks - 1
    after[last] = value[last].argmax(1)
    for k in range(deep - 1, 0, -1):
        here = first[chunks > k] + k
        after[here - 1] = origin[here, after[here]]
    path = np.empty((total, width), np.int64)
    state, every = after, np.arange(total)
    for t in range(width - 1, -1, -1):
        path[:, t] = state
        state = back[t][every, state]
    return path.reshape(-1)[cell]


def _slices(texts: list[str], states: int = 1) -> Iterator[list[str]]:
    held: list[str] = []
    size, most = 0, SLICE // max(1, states * states // FEW**2)
    for text in texts:
        if held and size + len(text) > most:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))


def _label(texts: list[str], model: Model, switch: float) -> tuple[list[str], list[float], pa.Array]:
    words = find_words(texts)
    n, states = len(texts), len(model.languages)
    if not states or not len(words.first):
        return [UNKNOWN] * n, [0.0] * n, pa.array([[]] * n, SPANS)
    path = viterbi(model.word_scores(words), words.text, switch)
    letters = np.zeros((n, states))
    np.add.at(letters, (words.text, path), words.letters)
    best, total = letters.argmax(1), letters.sum(1)
    names = [model.languages[b] if t else UNKNOWN for b, t in zip(best, total, strict=True)]
    share = (letters.max(1) / np.maximum(total, 1)).tolist()
    new = np.flatnonzero(np.append(True, (words.text[1:] != words.text[:-1]) | (path[1:] != path[:-1])))
    end = words.end[np.append(new[1:], len(path)) - 1]
    fields = [pa.array(words.start[new]), pa.array(end), pa.array(np.array(model.languages, object)[path[new]], pa.string())]
    offsets = np.searchsorted(words.text[new], np.arange(n + 1)).astype(np.int32)
    spans = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, ["start", "end", "lang"]))
    return names, share, spans


def label(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), switch: float = SWITCH) -> DataFrame:
    """``keep`` columns with ``lang_pred``, ``score`` and ``spans`` (start, end, lang; code points, end exclusive).

    ``score`` is the share of letters on the best path that are of ``lang_pred``. Null texts and texts without a letter are
    ``und`` with score 0 and no span, and so are all texts where the model knows no language. Ties go to the language that
    sorts first. Repeated rows are labelled each, an empty table gives no rows, and a very long text is held by one task with
    some 100 bytes for each of its letters. Columns of ``docs`` other than these are not looked at.
    """
    kinds = {f.name: f.dataType.simpleString() for f in docs.select(*[F.col(f"`{c}`") for c in keep]).schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in held(batches):
            at = 0
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for own in _slices(texts, len(model.languages)):
                names, share, spans = _label(own, model, switch)
                kept = batch.slice(at, len(own))
                at += len(own)
                columns = [*kept.columns[1:], pa.array(names, pa.string()), pa.array(share, pa.float64()), spans.cast(SPANS)]
                yield pa.record_batch(columns, names=[*keep, "lang_pred", "score", "spans"])

    read = docs.select(F.col(f"`{text}`").cast("string").alias("_text_"), *[F.col(f"`{c}`") for c in keep])
    columns = ", ".join(f"`{c}` {kind}" for c, kind in kinds.items())
    return read.mapInArrow(run, f"{columns}, lang_pred string, score double, spans array<struct<start:bigint,end:bigint,lang:string>>")
