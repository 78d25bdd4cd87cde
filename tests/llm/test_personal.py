import re
import time

import numpy as np
import pytest

from gaugeline.llm import personal
from gaugeline.llm.personal import KINDS, base_spans, luhn

# The base patterns as the contract writes them.
PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = (True, kind != 1 or all(int(p) <= 255 for p in m[0].split(".")), 13 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15)
            if good[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_is_the_patterns(spark):
    odd = ["a@b.c+d@e.f", "1.2.3.4.5.6.7.8 999.1.1.1", "@@a@b.", "x@y.z@w.q", "4111 1111 1111 1111-4111111111111111", "+1 (988) 555-2485. +49 30"]
    odd += ["..@a.b", "a@b@c.d", "0001.002.3.255", "é@x.y 漢a@b.c", "+12 34 56 78 9-", "1" * 50, "+1" * 20]
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    for text in odd + [r.text or "" for r in table]:
        assert base_spans(text) == plain(text)


@pytest.fixture(scope="module")
def model(spark):
    return personal.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_adds_what_is_written_otherwise(spark, model):
    rng = np.random.default_rng(3)
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("length(text) > 500").orderBy("doc_id").limit(200).collect()
    hit = added = clean = 0
    for n, row in enumerate(table):
        kind = n % 4
        put = personal._made(kind, rng)
        head = row.text[:200].rsplit(" ", 1)[0] + " "
        text = head + put + " " + row.text[200:400]
        (found,) = personal.find([text], model)
        hit += any((k, s, e) == (kind, len(head), len(head) + len(put)) for k, s, e, _ in found)
        assert [(k, s, e) for k, s, e, b in found if b] == base_spans(text)
        (found,) = personal.find([row.text], model)
        added += sum(not b for *_, b in found)
        clean += 1
    assert hit >= 0.9 * len(table)
    assert added <= 0.01 * clean


def test_odd_rows(documents, nothing, model):
    got = personal.personal_data(documents, model).collect()
    assert len(got) == documents.count()
    assert not any(r.spans for r in got)
    assert personal.personal_data(nothing, model).count() == 0
    assert personal.fit(nothing, steps=2) is not None


def test_spans_across_windows(spark, model):
    pad = "the word " * 400
    text = pad + "mail me.99@host7.example.org or +1 (988) 555-2485 " + pad + "1.2.3.4"
    row = personal.personal_data(spark.createDataFrame([(1, text)], "doc_id int, text string"), model).first()
    assert [s.kind for s in row.spans if s.base] == ["email", "ip", "phone"]
    assert [KINDS.index(s.kind) for s in row.spans] == sorted(KINDS.index(s.kind) for s in row.spans)


def test_long_spans_at_every_offset(model):
    fill = "we write the words of this page here and go on as the page before it did "
    parts = "department faculty university example institute sciences building research library campus college network group school centre".split()
    texts, want = [], []
    for size in range(3, 18, 2):
        host = " (dot) ".join((parts * 2)[: size - 1] + ["org"])
        put = f"firstname.lastname (at) {host}"
        if 64 <= len(put) <= 250:
            for offset in range(64):
                head = (fill * 4)[: 128 + offset - 1].rstrip() + " "
                head = " " * (128 + offset - len(head)) + head
                texts.append(head + put + " " + fill * 3)
                want.append((0, len(head), len(head) + len(put)))
    assert {(e - s) // 64 for _, s, e in want} == {1, 2, 3} and {s % 64 for _, s, _ in want} == set(range(64))
    hit = [w in [f[:3] for f in found] for w, found in zip(want, personal.find(texts, model), strict=True)]
    for at in range(0, len(hit), 64):
        assert all(hit[at : at + 64]), want[at]


def test_gradient_is_the_slope():
    from gaugeline.llm.tagger import Tagger

    rng = np.random.default_rng(1)
    model = Tagger.new(7, 3, 4, rng)
    x, y = rng.integers(0, 7, (2, 6)), rng.integers(0, 4, (2, 6))
    _, grads = model.gradient(x, y)
    for weight, grad in zip(model.weights(), grads, strict=True):
        at = tuple(rng.integers(0, n) for n in weight.shape)
        old, step = weight[at], np.float32(1e-2)
        weight[at] = old + step
        up, _ = model.gradient(x, y)
        weight[at] = old - step
        down, _ = model.gradient(x, y)
        weight[at] = old
        assert (up - down) / (2 * float(step)) == pytest.approx(float(grad[at]), abs=2e-3)


def test_digits_of_other_scripts_and_full_width(model):
    fill = "we write the words of this page here and go on as the page before it did "
    arabic = str.maketrans("0123456789", "٠١٢٣٤٥٦٧٨٩")
    cases = [(3, "+12 345 6789012".translate(arabic)), (1, "10.20.30.40".translate(arabic)), (0, "jane.miller＠example.org")]
    for kind, put in cases:
        text = fill + put + " " + fill
        (found,) = personal.find([text], model)
        assert (kind, len(fill), len(fill) + len(put), False) in found, (put, found)


def test_addresses_in_other_brackets(model):
    fill = "we write the words of this page here and go on as the page before it did "
    names = "jane marco petra oliver anna tobias lucas helen nina robert".split()
    hosts = "example university northwind harbour library".split()
    for at, dot in ((" {at} ", "."), ("{at}", "{dot}"), (" [at] ", " {dot} "), (" <at> ", " <dot> ")):
        texts, want = [], []
        for name in names:
            for host in hosts:
                put = f"{name}{at}{host}{dot}org"
                texts.append(fill + put + " " + fill)
                want.append((0, len(fill), len(fill) + len(put), False))
        hit = sum(w in found for w, found in zip(want, personal.find(texts, model), strict=True))
        assert hit >= 0.9 * len(texts), (at, dot, hit)
    for prose in (fill + "look at the page and the dot on it " + fill, fill + "meet us at example.org for more " + fill):
        assert not any(not b for *_, b in personal.find([prose], model)[0]), prose


def test_a_text_of_very_many_spans_takes_linear_time(monkeypatch):
    text = "jane [at] example.org " * 100_000

    def by_pattern(texts, model, windows, length):
        for n, begin in windows:
            part = texts[n][begin : begin + length]
            yield [
                personal._Added(0, begin + m.start(), begin + m.end(), 0.9, (m.start() > 0 or begin == 0) and (m.end() < len(part) or begin + length >= len(texts[n])))
                for m in re.finditer(r"[a-z]+ \[at\] [a-z]+\.[a-z]+", part)
            ]

    monkeypatch.setattr(personal, "_decoded", by_pattern)
    begin = time.monotonic()
    (found,) = personal.find([text], None)
    assert time.monotonic() - begin < 60
    assert [f[1] for f in found][1:-1] == list(range(22, len(text) - 22, 22))


def test_the_sample_is_bounded_at_any_size():
    for rows in (0, 10, 10_000, 10**10, 10**13):
        expected = rows * personal._bound(rows, 600) / 2**62
        assert min(rows, 2400) <= expected + 1e-6 and expected <= 2401


def test_copies_of_a_text_are_one_of_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(personal, "_examples", lambda windows, rng: seen.append(windows) or (None, None))
    monkeypatch.setattr(personal, "train", lambda *_: None)
    rows = [(n, "the same text of a third of all rows, " * 5) for n in range(500)] + [(n, f"text {n} of its own " * 9) for n in range(500, 1500)]
    personal.fit(spark.createDataFrame(rows, "doc_id int, text string"), sample=100)
    assert len(seen[0]) == len(set(seen[0])) == 200
