"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

Texts are runs of letters and digits in lower case, and their five-word shingles. A template of ``m`` shingles belongs to
the scale ``s``, the power of two not below ``m``. At each scale a text is cut into windows of ``2 s`` shingles, each
beginning ``s`` after the one before, so that every run of ``s`` lies within one. A window that holds four fifths of a
template has a Jaccard similarity above 0.19 with it, and one of 64 bands (of one minimum each)
agrees with probability above 0.999998. Templates that repeat themselves so much that this doesn't hold are looked up by
their shingles. Hits are verified on the shingles themselves.

Templates are short notices and, in ``license_texts``, whole licenses without the lines that name a holder.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.shingles import shingles, slices, word_hashes

WORDS = 5
CONTAINED = 0.8
BANDS = 64
# Notices by which works declare their license.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
)
WHOLE = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0")
NO_WORD = re.compile(r"[\W_]")


@lru_cache(maxsize=1)
def whole_texts() -> tuple[tuple[str, str], ...]:
    """Name and text of the whole licenses; the BSD ones under the name of their notice."""
    texts = resources.files("gaugeline.llm") / "license_texts"
    return tuple(("BSD" if name.startswith("BSD") else name, (texts / f"{name}.txt").read_text("utf-8")) for name in WHOLE)


def _plain(text: str) -> str:
    """The text with a space for each character that is neither letter nor digit; as long as before."""
    return NO_WORD.sub(" ", text)


class Scanner:
    def __init__(self, templates: Sequence[tuple[str, str]]) -> None:
        self.names = [name for name, _ in templates]
        rng = np.random.default_rng(11)
        self.factors = rng.integers(0, 1 << 63, BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        value, text, _ = shingles(word_hashes([_plain(t) for _, t in templates], fold=True), WORDS)
        self.value = [value[text == i] for i in range(len(templates))]
        if any(not len(v) for v in self.value):
            raise ValueError("a template without a word")
        self.places: list[dict[int, list[int]]] = []
        self.scales: dict[int, list[int]] = {}
        self.repeating = []
        for i, v in enumerate(self.value):
            places: dict[int, list[int]] = {}
            for n, shingle in enumerate(v.tolist()):
                places.setdefault(shingle, []).append(n)
            self.places.append(places)
            scale = 1 << (len(v) - 1).bit_length()
            self.scales.setdefault(scale, []).append(i)
            if 2 * len(places) <= scale:
                self.repeating.append(i)
        self.minima = np.array([[(v * f).min() for f in self.factors] for v in self.value])

    def retrieve(self, value: np.ndarray, text: np.ndarray) -> set[tuple[int, int]]:
        """(text, template) pairs of which a window and the template agree in a band."""
        found: set[tuple[int, int]] = set()
        if not len(value):
            return found
        for i in self.repeating:
            found.update((t, i) for t in np.unique(text[np.isin(value, self.value[i])]).tolist())
        first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        place = np.arange(len(value)) - np.repeat(first, np.diff(np.append(first, len(value))))
        # Blocks of a scale are made of those of the scale below.
        blocks, begin = [], np.arange(len(value))
        for scale, members in sorted(self.scales.items()):
            inner = np.flatnonzero(place[begin] % scale == 0)
            begin = begin[inner]
            of = text[begin]
            blocks.append((inner, of, np.append(of[1:] == of[:-1], False), members))
        for band, factor in enumerate(self.factors):
            low = value * factor
            for inner, of, joined, members in blocks:
                if len(inner) < len(low):
                    low = np.minimum.reduceat(low, inner)
                # A window is a block and the next one of the same text.
                window = np.where(joined, np.minimum(low, np.append(low[1:], low[-1])), low)
                for i in members:
                    for t in np.unique(of[window == self.minima[i, band]]).tolist():
                        found.add((t, i))
        return found

    def verify(self, value: np.ndarray, i: int) -> list[tuple[int, int, float]]:
        """First and last shingle, and share of the template's shingles, of each occurrence in a text.

        Shingles in the template's order are one occurrence, whatever else lies between; a shingle that the template holds at
        several places goes to the first one that keeps the order. Where the order is broken, an occurrence is what a window
        of the template's length holds, or of twice that and so on.
        """
        places, size = self.places[i], len(self.value[i])
        known = np.array(sorted(places), np.uint64)
        at = np.flatnonzero(known[np.minimum(np.searchsorted(known, value), len(known) - 1)] == value)
        hits, names = at.tolist(), value[at].tolist()

        def share(a: int, b: int) -> float:
            return len(set(names[a:b])) / len(places)

        if share(0, len(hits)) < CONTAINED:
            return []
        far = [h for h in range(1, len(hits)) if hits[h] - hits[h - 1] > size + WORDS]
        out = []
        for low, high in zip([0, *far], [*far, len(hits)], strict=True):
            runs, begin, turn = [], low, -1
            for h in range(low, high):
                own = places[names[h]]
                later = bisect_right(own, turn)
                if later == len(own):
                    runs.append((begin, h))
                    begin, later = h, 0
                turn = own[later]
            runs = [r for r in [*runs, (begin, high)] if share(*r) >= CONTAINED]
            found, free = [], low
            for n, (a, b) in enumerate(runs):
                a, b = self._grown(hits, names, i, a, b, free, runs[n + 1][0] if n + 1 < len(runs) else high)
                found.append((a, b))
                free = b
            edges = [low, *[e for r in found for e in r], high]
            for a, b in zip(edges[::2], edges[1::2], strict=True):
                found += self._windows(hits, names, i, a, b)
            out += [(hits[a], hits[b - 1], share(a, b)) for a, b in sorted(found)]
        return out

    def _grown(self, hits: list[int], names: list[int], i: int, a: int, b: int, low: int, high: int) -> tuple[int, int]:
        """An occurrence with what it still lacks and has close by, at most a quarter longer than the template."""
        places, room = self.places[i], len(self.value[i]) * 5 // 4
        held = Counter(names[a:b])
        for h in range(a - 1, low - 1, -1):
            if hits[b - 1] - hits[h] >= room:
                break
            if held[names[h]] < len(places[names[h]]):
                held[names[h]] += 1
                a = h
        for h in range(b, high):
            if hits[h] - hits[a] >= room:
                break
            if held[names[h]] < len(places[names[h]]):
                held[names[h]] += 1
                b = h + 1
        return a, b

    def _windows(self, hits: list[int], names: list[int], i: int, low: int, high: int) -> list[tuple[int, int]]:
        """Occurrences in any order: the windows that hold most, the shortest windows first."""
        places, length = self.places[i], len(self.value[i])
        out, parts = [], [(low, high)]
        while parts:
            left = []
            for low, high in parts:
                if len(set(names[low:high])) / len(places) < CONTAINED:
                    continue
                held: Counter[int] = Counter()
                good, b = [], low
                for a in range(low, high):
                    while b < high and hits[b] - hits[a] < length:
                        held[names[b]] += 1
                        b += 1
                    if len(held) / len(places) >= CONTAINED:
                        good.append((-len(held), a, b))
                    held[names[a]] -= 1
                    if not held[names[a]]:
                        del held[names[a]]
                taken, used = [], bytearray(high - low)
                for _, a, b in sorted(good):
                    # Windows are of one length, so one that meets another has an end in it.
                    if used[a - low] or used[b - 1 - low]:
                        continue
                    used[a - low : b - low] = b"\1" * (b - a)
                    held = Counter(names[a:b])
                    while held[names[b - 1]] > len(places[names[b - 1]]):
                        b -= 1
                        held[names[b]] -= 1
                    while held[names[a]] > len(places[names[a]]):
                        held[names[a]] -= 1
                        a += 1
                    taken.append((a, b))
                out += taken
                if hits[high - 1] - hits[low] >= length:
                    edges = [low, *[e for r in sorted(taken) for e in r], high]
                    left += zip(edges[::2], edges[1::2], strict=True)
            parts, length = left, 2 * length
        return out

    def __call__(self, texts: list[str]) -> list[tuple[int, str, int, int, float]]:
        """``text, license, start, end, contained`` of each match, the best one of those that overlap."""
        words = word_hashes([_plain(t) for t in texts], fold=True)
        value, text, at = shingles(words, WORDS)
        edges = np.searchsorted(text, np.arange(len(texts) + 1))
        found = []
        for t, i in sorted(self.retrieve(value, text)):
            begin, end = edges[t], edges[t + 1]
            for low, high, share in self.verify(value[begin:end], i):
                first = at[begin + low]
                last = min(at[begin + high] + WORDS - 1, np.searchsorted(words.text, t, "right") - 1)
                found.append((t, self.names[i], int(words.start[first]), int(words.end[last]), share, round(share * len(self.places[i]))))
        kept: list[tuple] = []
        # A mark on each character of a text that a better match holds.
        marks: dict[int, bytearray] = {}
        for m in sorted(found, key=lambda m: (m[0], -m[5], -m[4], m[2])):
            if m[0] not in marks:
                marks = {m[0]: bytearray(len(texts[m[0]]))}
            if marks[m[0]].find(1, m[2], m[3]) < 0:
                marks[m[0]][m[2] : m[3]] = b"\1" * (m[3] - m[2])
                kept.append(m)
        return [m[:5] for m in sorted(kept)]


def license_scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    templates: Sequence[tuple[str, str]] | None = None,
) -> DataFrame:
    """``doc_id, license, start, end, contained``: one row per notice found, in code points, end exclusive.

    ``contained`` is the share of a template's five-word shingles in the match, 0.8 at least; a template of fewer words is one
    shingle. Of overlapping matches the one that holds most of a template stays. Null and empty texts give no row, repeated
    rows give theirs each; an empty table gives none; extra columns are not looked at. A text of any length is scanned whole,
    in time linear in its length and its matches. Without ``templates`` the notices and the whole licenses are.
    """
    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()
    templates = tuple(TEMPLATES + whole_texts() if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            for begin, own in slices([t or "" for t in batch.column("text").to_pylist()]):
                found = scanner(own)
                columns = list(zip(*found, strict=True)) or [[]] * 5
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").take(pa.array([begin + t for t in columns[0]], pa.int64())),
                        "license": pa.array(columns[1], pa.string()),
                        "start": pa.array(columns[2], pa.int64()),
                        "end": pa.array(columns[3], pa.int64()),
                        "contained": pa.array(columns[4], pa.float64()),
                    }
                )

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, f"doc_id {kind}, license string, start bigint, end bigint, contained double")
