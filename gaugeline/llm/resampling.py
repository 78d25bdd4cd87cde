"""Importance resampling towards a target: documents drawn by hashed n-gram likelihoods and Gumbel noise.

Texts of a batch are joined with a sentinel between them and one regular-expression pass finds all words. Where each word
begins says by ``searchsorted`` over the texts' offsets whose it is; runs of words whose ends differ in text are masked before
buckets are counted by ``bincount``. A bucket's gain is the whole-number log ratio of its smoothed share
in the target and in the corpus, a document's weight the sum of its features' gains. Adding Gumbel noise made of the id and
drawing the highest scores samples without replacement, in proportion to the weights' exponentials.

The counts, a fixed number of buckets, are all that comes to the driver; documents are ranked by range and running totals.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import running, written
from gaugeline.llm.shingles import held, slices

BUCKETS = 10_000
# Longest run of words that is a feature.
LONGEST = 1
# Documents of fewer words are not drawn.
LEAST_WORDS = 20
# Share drawn, as a fraction of whole numbers.
DRAW = (10, 100)
SEED = "2024"
# Nats to whole numbers.
SCALE = 1000.0
# Words whose CRC a task remembers.
REMEMBER = 500_000

# Bytes that make words once A-Z is in lower case, those of all characters beyond ASCII among them, and one that doesn't.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SENTINEL = b"\n"


@dataclass
class Features:
    """Bucket and text of each feature, and the number of words of each text."""

    bucket: np.ndarray
    text: np.ndarray
    words: np.ndarray


class Reader:
    """Finds the features of several texts at once."""

    def __init__(self, longest: int = LONGEST, buckets: int = BUCKETS) -> None:
        self.longest, self.buckets = longest, buckets
        self.known: dict[bytes, int] = {}

    def _crc(self, words: list[bytes]) -> np.ndarray:
        found = list(map(self.known.get, words))
        if None in found:
            if len(self.known) > REMEMBER:
                self.known.clear()
            for i, crc in enumerate(found):
                if crc is None:
                    found[i] = self.known[words[i]] = zlib.crc32(words[i])
        return np.array(found, np.int64)

    def __call__(self, texts: list[str]) -> Features:
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        offset = np.concatenate([[0], np.cumsum([len(t) + len(SENTINEL) for t in raw])[:-1]]).astype(np.int64)
        words, starts = [], []
        for match in WORD.finditer(SENTINEL.join(raw).lower()):
            words.append(match.group())
            starts.append(match.start())
        text = np.searchsorted(offset, np.array(starts, np.int64), "right") - 1
        crc = self._crc(words)
        buckets, owners = [crc % self.buckets], [text]
        for n in range(2, self.longest + 1):
            inside = np.flatnonzero(text[: max(len(text) - n + 1, 0)] == text[n - 1 :])
            longer = [zlib.crc32(b" " + b" ".join(words[i + 1 : i + n]), int(crc[i])) for i in inside]
            buckets.append(np.array(longer, np.int64) % self.buckets)
            owners.append(text[inside])
        return Features(np.concatenate(buckets), np.concatenate(owners), np.bincount(text, minlength=len(texts)))


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket's features stand in all texts; tasks add up their own, Spark the tasks'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, total = Reader(longest, buckets), np.zeros(buckets, np.int64)
        for batch in held(batches):
            for _, part in slices([t or "" for t in batch.column("text").to_pylist()]):
                total += np.bincount(reader(part).bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(at.astype(np.int64)), "n": pa.array(total[at])})

    found = texts.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for bucket, n in found.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole-number gain of each bucket, both counts smoothed by one."""
    above = (target + 1.0) * float(corpus.sum() + len(corpus))
    below = (corpus + 1.0) * float(target.sum() + len(target))
    return np.floor(SCALE * np.log(above / below)).astype(np.int64)


def weighted(
    docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", longest: int = LONGEST
) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of each row; a text without words has no features and weight 0."""
    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(longest, len(gain))
        for batch in held(batches):
            sums = np.zeros((3, batch.num_rows), np.int64)
            for first, part in slices([t or "" for t in batch.column("text").to_pylist()]):
                found, here = reader(part), slice(first, first + len(part))
                sums[0, here] = found.words
                sums[1, here] = np.bincount(found.text, minlength=len(part))
                # In whole numbers: sums of doubles would stop being exact.
                np.add.at(sums[2, here], found.text, gain[found.bucket])
            columns = dict(zip(("n_words", "n_features", "weight"), map(pa.array, sums), strict=True))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), **columns})

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Whole-number Gumbel noise made of the id; a null id counts as empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-SCALE) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    draw: tuple[int, int] = DRAW,
    least_words: int = LEAST_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_features, weight, score, rank``; ``rank`` is null where a row isn't drawn.

    Of the N rows with at least ``least_words`` words the ``floor(N * draw[0] / draw[1])`` of highest score are drawn, ties to
    the smaller id, null first; repeated rows are drawn each on their own, as alike. Null texts have no
    words; an empty target or corpus counts as smoothing alone, an empty table gives no rows. A text longer than a part
    is read alone and whole, so a task holds its words at once. Extra columns are not looked at.
    """
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    rows = weighted(docs, gain, doc_id, text, longest)
    rows = written(rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scores")
    # As a fraction of whole numbers: nothing is rounded.
    drawn = rows.filter(F.col("n_words") >= least_words).count() * draw[0] // draw[1]
    wide = rows.filter(F.col("n_words") >= least_words)
    ranked = running(wide, [], [-F.col("score"), F.col("doc_id"), F.col("weight"), F.col("n_features")], F.lit(1), "place")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    rest = rows.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.withColumn("rank", rank).drop("place").unionByName(rest)
