"""Personal data in texts: plain patterns, and a character tagger that adds what is written otherwise.

The patterns (base spans) find e-mail addresses, IP addresses, card numbers and international phone numbers. The
tagger, a bidirectional LSTM with CRF transitions over characters, is trained on text of the corpus whose base spans are
labelled and on generated spans put into such text: addresses with ``[at]`` and ``(dot)``, cards with other
separators, phones without a plus. It reads digits of any script, full-width characters
and other brackets as their plain forms. Texts are cut into overlapping windows, each is decoded, and spans
of all windows are reconciled per text: spans cut off by a window's edge yield to the window that holds them
whole, or are decoded again in one that does, however long; better ones go first, none may overlap another of its kind or any base span, and the digits or parts of each must make
sense for its kind.

A span holds a digit of any script, an at sign or an opening bracket, so windows without any of these can't hold one
and aren't decoded. An address spelled in words alone (``jane at example dot org``) is none here.

The work on a text grows with its length and the number of its spans, never with pairs of spans.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.tagger import Tagger, train

KINDS = ("email", "ip", "card", "phone")
# The patterns of the base spans, in a form that reads a text once.
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
# What an address goes on with, as far as it goes, on its left and on its right.
DOT_BEFORE = re.compile(r"\s?[\[({<]dot[\])}>]\s?\Z", re.I)
HOST_MORE = re.compile(r"[A-Za-z0-9-]*+(?:(?:\.|\s?[\[({<]dot[\])}>]\s?)[A-Za-z0-9-]++)*+", re.I)
EVIDENCE = re.compile(r"[\d@\uFE6B\uFF08\uFF20\uFF3B\uFF5B\[({<]")
# Ways to write an at sign and a dot in an added address.
SPELLED_AT = re.compile(r"\s*[\[({<]at[\])}>]\s*|\s+@\s+", re.I)
SPELLED_DOT = re.compile(r"\s*[\[({<]dot[\])}>]\s*", re.I)

WINDOW, STRIDE = 128, 64
HIDDEN = 16
# Documents whose text the tagger is trained on, about; steps and windows per step.
SAMPLE, STEPS, BATCH = 600, 450, 48
SEED = 5
# Mean posterior probability that an added span's tags must have.
SURE = 0.8
DECODE = 512


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _is_ip(text: str) -> bool:
    # Leading zeros don't count; longer parts are never read as numbers.
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the plain patterns, leftmost and without overlap per kind, in order."""
    found = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        host = EMAIL_HOST.match(text, at + 1) if start < at else None
        free = host.end() if host else at + 1
        if host:
            found.append((0, start, free))
        at = text.find("@", free)
    if DIGIT.search(text):
        found += [(1, m.start(), m.end()) for m in IP.finditer(text) if _is_ip(m[0])]
        for m in CARD.finditer(text):
            if 12 < m.end() - m.start() < 40:
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found.append((2, m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append((3, m.start(), m.end()))
    return found


# ---- training ----------------------------------------------------------------------------------

TAGS = 1 + 2 * len(KINDS)
SYMBOLS = 100


@lru_cache(maxsize=1)
def _plain_forms() -> dict[int, str]:
    """ASCII digits for those of other scripts, ASCII for full-width characters, square brackets for curly and angle ones."""
    forms = {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)} | {0xFE6B: "@"}
    forms |= {ord(c): plain for c, plain in zip("{<}>", "[[]]", strict=True)}
    for c in range(128, 0x20000):
        if unicodedata.category(chr(c)) == "Nd":
            forms[c] = str(unicodedata.digit(chr(c)))
    return forms


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """Symbol of each code point: printable ASCII its own, as has what stands for it, then letters, spaces and all others."""
    table = np.zeros(0x110000, np.int16)
    for c in range(len(table)):
        if c < 0x3000 and chr(c).isalpha():
            table[c] = 1
    table[[9, 10, 11, 12, 13, 0xA0]] = 2
    table[32:127] = np.arange(3, 98)
    for c, plain in _plain_forms().items():
        table[c] = table[ord(plain)]
    return table


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _letters(rng: np.random.Generator, low: int, high: int) -> str:
    return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(low, high)))


def _digits(rng: np.random.Generator, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def _long_address(rng: np.random.Generator) -> str:
    """An address written otherwise, of many parts."""
    pick = lambda *options: options[rng.integers(len(options))]
    at = pick("[at]", "(at)", " [at] ", " (at) ", " @ ")
    dot = pick(".", "[dot]", "(dot)", " [dot] ", " (dot) ", " (dot) ")
    name = pick(".", "_", dot).join(_letters(rng, 2, 13) for _ in range(rng.integers(1, 4)))
    host = [_letters(rng, 2, 15) for _ in range(rng.integers(2, 13))]
    return name + at + dot.join([*host, pick("com", "org", "net", "edu", "de", "fr")])


def _made(kind: int, rng: np.random.Generator, words: list[str] | None = None) -> str:
    """A generated span, plain or written otherwise; every other name and host is one of ``words``, if any."""
    own = lambda: words[rng.integers(len(words))] if words and rng.integers(2) else _letters(rng, 3, 9)
    pick = lambda *options: options[rng.integers(len(options))]
    if kind == 0 and rng.integers(4) == 0:
        return _long_address(rng)
    if kind == 0:
        at = pick("@", "@", "[at]", "(at)", " [at] ", " (at) ", " @ ")
        dot = "." if at == "@" else pick(".", "[dot]", "(dot)", " [dot] ", " (dot) ")
        name = own() + pick("", "", "." + _letters(rng, 2, 7), "." + _digits(rng, 2), "_" + _letters(rng, 2, 5))
        return name + at + own() + pick("", _digits(rng, 1)) + dot + pick("com", "org", "net", "example" + dot + "com", "de", "fr")
    if kind == 1:
        return pick(".", ".", "[.]", "(.)", " . ").join(str(n) for n in rng.integers(1, 256, 4))
    if kind == 2:
        digits = pick("4", "5", "37") + _digits(rng, 14)
        digits = digits[:15]
        digits += next(str(d) for d in range(10) if luhn(digits + str(d)))
        return pick("", " ", "-", ".", "  ", "/", "_").join((digits[:4], digits[4:8], digits[8:12], digits[12:]))
    area, first, last = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
    return pick(f"+1 ({area}) {first}-{last}", f"+{_digits(rng, 2)} {area} {first}{last}", f"({area}) {first}-{last}", f"{area}-{first}-{last}",
                f"{area}.{first}.{last}", f"00{_digits(rng, 2)} {area} {first} {last}", f"1-{area}-{first}-{last}")


def _plain_number(rng: np.random.Generator) -> str:
    """Digits and brackets that are no personal data."""
    pick = lambda *options: options[rng.integers(len(options))]
    return pick(str(rng.integers(1900, 2031)), f"{rng.integers(1, 1000)},{_digits(rng, 3)}.{_digits(rng, 2)}", f"{_digits(rng, 4)}-{_digits(rng, 2)}-{_digits(rng, 2)}",
                f"v{_digits(rng, 1)}.{_digits(rng, 1)}.{_digits(rng, 2)}", f"{_digits(rng, 2)}:{_digits(rng, 2)}:{_digits(rng, 2)}", f"[{_digits(rng, 1)}]", f"({_letters(rng, 3, 9)})",
                "key=" + "".join(rng.choice(list("0123456789abcdef"), 18)), f"{_digits(rng, 2)}%", "AKIA" + "".join(rng.choice(list("ABCDEFGHJKLMNPQR0123456789"), 16)),
                f"#{_digits(rng, 6)}", f"{_digits(rng, 12)}", f"{_digits(rng, 3)} - {_digits(rng, 3)}", f"[{_letters(rng, 2, 4)}]", f"{_digits(rng, 8)}")


def _examples(contexts: list[str], rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Windows of symbols and their tags: each context with what it holds, and twice with something put in."""
    table = _symbols()
    words = re.findall(r"[a-z]{3,12}", " ".join(contexts))
    x = np.full((3 * len(contexts), WINDOW), table[32], np.int16)
    y = np.zeros((3 * len(contexts), WINDOW), np.int64)
    for n in range(3 * len(contexts)):
        text, put, shift = contexts[n // 3][:WINDOW], "", 0
        own: list[tuple[int, int, int]] = []
        if n % 3:
            cut = [m.end() for m in re.finditer(r"\s", text[: WINDOW // 2])] or [0]
            at = cut[rng.integers(len(cut))]
            kind = int(rng.integers(0, 6))
            put = _made(kind, rng, words) if kind < 4 else _plain_number(rng)
            text = text[:at] + put + ("", ".", ",")[rng.integers(3)] + " " + text[at:]
            own = [(kind, at, at + len(put))] if kind < 4 else []
            # Of what windows can cut off, any part.
            if len(put) > WINDOW - STRIDE:
                shift = int(rng.integers(0, at + len(put)))
        spans = own + [s for s in base_spans(text) if not any(s[1] < o[2] and o[1] < s[2] for o in own)]
        codes = table[_codes(text[shift : shift + WINDOW])]
        x[n, : len(codes)] = codes
        for kind, start, end in spans:
            y[n, max(0, start - shift) : max(0, end - shift)] = 2 + 2 * kind
            if start >= shift:
                y[n, start - shift : start - shift + 1] = 1 + 2 * kind
    return x, y


def _bound(rows: int, sample: int) -> int:
    """Hashes below this, of 62 bits, are those of some four samples of the texts: copies are not known yet."""
    return min(1 << 62, -(-4 * sample * (1 << 62) // max(rows, 1)))


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE, steps: int = STEPS) -> Tagger:
    """The tagger, trained on ``2 * sample`` windows at most, of distinct texts chosen by a hash.

    A text gives two windows: one around its first evidence of personal data, if any, and one from its middle.
    """
    rows = docs.select(F.col(text).cast("string").alias("text")).filter(F.length("text") >= WINDOW // 2)
    rows = rows.filter(F.shiftrightunsigned(F.xxhash64("text"), 2) < F.lit(_bound(docs.count(), sample)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                seen = EVIDENCE.search(text)
                middle = max(0, len(text) // 2 - WINDOW // 2)
                out += [text[s : s + WINDOW] for s in {max(0, seen.start() - WINDOW // 3) if seen else middle, middle}]
            yield pa.record_batch({"window": pa.array(out, pa.string())})

    # Copies give equal windows and fall together before they are shuffled. Sorted, so that reruns train alike.
    distinct = rows.mapInArrow(cut, "window string").distinct()
    windows = sorted(r["window"] for r in distinct.orderBy(F.xxhash64("window"), "window").limit(2 * sample).collect())
    rng = np.random.default_rng(SEED)
    windows = windows or ["the number is below and the rest follows " * 3]
    while len(windows) < 200:
        windows = windows + windows
    x, y = _examples(windows, rng)
    return train(x, y, SYMBOLS, TAGS, HIDDEN, steps, BATCH, SEED)


# ---- finding -----------------------------------------------------------------------------------


@dataclass
class _Added:
    kind: int
    start: int
    end: int
    sure: float
    whole: bool
    again: bool = False


def _sensible(kind: int, text: str) -> bool:
    """Does the text of an added span make a value of its kind?"""
    text = text.translate(_plain_forms())
    if kind == 0:
        plain = SPELLED_DOT.sub(".", SPELLED_AT.sub("@", text))
        found = base_spans(plain)
        return (0, 0, len(plain)) in found
    if kind == 1:
        plain = re.sub(r"\s*(?:\[\.\]|\(\.\)|\.)\s*", ".", text)
        return bool(IP.fullmatch(plain)) and _is_ip(plain)
    digits = re.sub(r"[^0-9]", "", text)
    if re.search(r"[^0-9\s+()./_-]", text):
        return False
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits) and len(set(digits)) > 1
    return 9 <= len(digits) <= 15 and bool(re.search(r"[\s().-]", text))


def _full_address(text: str, start: int, end: int) -> tuple[int, int]:
    """An added address with the rest of the name and the host that it begins or ends within."""
    while start:
        if text[start - 1] in EMAIL_LOCAL:
            start -= 1
            continue
        dot = DOT_BEFORE.search(text, max(0, start - 7), start)
        if not dot or not dot.start() or text[dot.start() - 1] not in EMAIL_LOCAL:
            break
        start = dot.start()
    return start, HOST_MORE.match(text, end).end()


def _window_spans(path: np.ndarray, share: np.ndarray, begin: int, size: int) -> Iterator[_Added]:
    at = 0
    while at < len(path):
        tag = int(path[at])
        if not tag:
            at += 1
            continue
        end, inside = at + 1, tag + tag % 2
        while end < len(path) and path[end] == inside:
            end += 1
        stop = min(begin + end, size)
        if begin + at < stop:
            whole = (at > 0 or begin == 0) and (end < len(path) or begin + end >= size)
            yield _Added((tag - 1) // 2, begin + at, stop, float(share[at:end].mean()), whole)
        at = end


def _decoded(texts: list[str], model: Tagger, windows: list[tuple[int, int]], length: int) -> Iterator[list[_Added]]:
    """The spans of each window, given by its text and first character."""
    space = _symbols()[32]
    step = max(1, DECODE * WINDOW // length)
    for at in range(0, len(windows), step):
        own = windows[at : at + step]
        x = np.full((len(own), length), space, np.int16)
        for i, (n, begin) in enumerate(own):
            codes = _symbols()[_codes(texts[n][begin : begin + length])]
            x[i, : len(codes)] = codes
        path, share = model.decode(x)
        some = path.any(1)
        for i, (n, begin) in enumerate(own):
            yield list(_window_spans(path[i], share[i], begin, len(texts[n]))) if some[i] else []


def _merged(parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Parts of a text, those that meet made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(parts):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _whole_ones(texts: list[str], base: list[list[tuple[int, int, int]]], added: dict[int, list[_Added]], model: Tagger) -> None:
    """Puts to ``added`` what edges of windows cut off, decoded again in windows that grow until they hold it."""
    cut: dict[int, list[tuple[int, int]]] = {}
    for n, own in added.items():
        good = sorted((a.start, a.end) for a in own if a.whole and a.sure >= SURE and _sensible(a.kind, texts[n][a.start : a.end]))
        # How far the good ones reach that begin at or before each.
        reached = list(accumulate((e for _, e in good), max))
        plain = _merged([(s, e) for _, s, e in base[n]])
        begins = [s for s, _ in plain]
        for a in own:
            at = bisect_right(begins, a.start) - 1
            held = bisect_right(good, (a.start, len(texts[n]))) - 1
            within = (at >= 0 and a.end <= plain[at][1]) or (held >= 0 and a.end <= reached[held])
            if not a.whole and not within:
                cut.setdefault(n, []).append((a.start, a.end))
    reach = STRIDE
    while cut:
        sized: dict[int, list[tuple[int, int, int, int]]] = {}
        for n, parts in cut.items():
            for start, end in _merged(parts):
                begin = max(0, start - reach)
                length = -(-(min(end + reach, len(texts[n])) - begin) // STRIDE) * STRIDE
                sized.setdefault(length, []).append((n, begin, start, end))
        cut = {}
        for length, own in sized.items():
            for (n, _, start, end), spans in zip(own, _decoded(texts, model, [o[:2] for o in own], length), strict=True):
                for a in spans:
                    if start < a.end and a.start < end:
                        if a.whole:
                            a.again = True
                            added[n].append(a)
                        else:
                            cut.setdefault(n, []).append((min(start, a.start), max(end, a.end)))
        reach *= 2


def find(texts: list[str], model: Tagger) -> list[list[tuple[int, int, int, bool]]]:
    """Per text (kind, start, end, base) of all spans, by kind and start."""
    base = [base_spans(t) for t in texts]
    windows: list[tuple[int, int]] = []
    for n, text in enumerate(texts):
        last = -1
        for m in EVIDENCE.finditer(text):
            for k in (m.start() // STRIDE - 1, m.start() // STRIDE):
                if k > last:
                    windows.append((n, k * STRIDE))
                    last = k
    added: dict[int, list[_Added]] = {}
    for (n, _), spans in zip(windows, _decoded(texts, model, windows, WINDOW), strict=True):
        if spans:
            added.setdefault(n, []).extend(spans)
    _whole_ones(texts, base, added, model)
    out = []
    for n, text in enumerate(texts):
        kept = [(k, s, e, True) for k, s, e in base[n]]
        # Per kind a mark on each character that is taken; base spans take it for all kinds.
        plain = bytearray(len(text) if n in added else 0)
        for _, s, e in base[n] if n in added else ():
            plain[s:e] = b"\1" * (e - s)
        marks: dict[int, bytearray] = {}
        for a in sorted(added.get(n, []), key=lambda a: (not a.whole, not a.again, -a.sure, a.start, a.end, a.kind)):
            if a.kind == 0 and a.whole and a.sure >= SURE:
                a.start, a.end = _full_address(text, a.start, a.end)
            if a.sure < SURE or not a.whole or not _sensible(a.kind, text[a.start : a.end]):
                continue
            if a.kind not in marks:
                marks[a.kind] = plain[:]
            own = marks[a.kind]
            if own.find(1, a.start, a.end) < 0:
                own[a.start : a.end] = b"\1" * (a.end - a.start)
                kept.append((a.kind, a.start, a.end, False))
        out.append(sorted(kept))
    return out


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
HELD = 256


def personal_data(docs: DataFrame, model: Tagger, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, spans`` (kind, start, end, base; by kind and start; code points, end exclusive) of each row's whole text.

    ``base`` tells spans of the plain patterns from those the tagger added. Null and empty texts have none, repeated rows
    are searched each; an empty table gives no row; extra columns are not looked at. A text of any length is one
    unit of work, linear in its length.
    """
    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, HELD):
                part = batch.slice(at, HELD)
                found = find([t or "" for t in part.column("text").to_pylist()], model)
                rows = [[{"kind": KINDS[k], "start": s, "end": e, "base": b} for k, s, e, b in spans] for spans in found]
                yield pa.record_batch({"doc_id": part.column("doc_id"), "spans": pa.array(rows, SPANS)})

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
