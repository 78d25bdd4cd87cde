import re
import time

from gaugeline.llm.licenses import TEMPLATES, license_scan

FILL = "some words that are no license at all and go on for a while here now "


def test_finds_what_is_contained(spark):
    mit = TEMPLATES[3][1]
    words = mit.split()
    changed = " ".join([*words[:14], "CHANGED", *words[15:]])
    broken = " ".join("no" if i % 4 == 0 else w for i, w in enumerate(words))
    texts = [FILL * 40 + mit + " " + FILL, FILL + changed, FILL + broken, FILL * 3, None, "", mit + " " + FILL * 30 + mit.upper(), "Released under the MIT License."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {}
    for r in license_scan(df).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sorted(got) == [0, 1, 6, 7]
    assert len(got[6]) == 2
    (r,) = got[0]
    assert r.license == "MIT" and r.contained == 1.0 and texts[0][r.start : r.end] == mit
    assert 0.8 <= got[1][0].contained < 1


def test_equals_pattern_on_the_table(spark, documents, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    notices = {"Apache-2.0": TEMPLATES[0][1], "MIT": TEMPLATES[2][1], "GPL-3.0": TEMPLATES[4][1], "CC-BY-NC-4.0": TEMPLATES[7][1]}
    want = []
    for r in docs.select("doc_id", "text").collect():
        for name, notice in notices.items():
            want += [(r.doc_id, name, m.start()) for m in re.finditer(re.escape(notice[:-1]), r.text or "", re.I)]
    assert sorted((r.doc_id, r.license, r.start) for r in license_scan(docs).collect()) == sorted(want)
    assert license_scan(documents).count() == 0
    assert license_scan(nothing).count() == 0


def test_a_whole_license_repeats_its_words():
    from gaugeline.llm.licenses import CONTAINED, Scanner, whole_texts

    scanner = Scanner(TEMPLATES + whole_texts())
    before, after = FILL * 9 + "under the license. ", "\n" + FILL * 9
    for name, whole in whole_texts():
        for text in (before + whole + after, before + whole + after + whole):
            found = [(lic, share) for _, lic, start, end, share in scanner([text]) if end - start > 500]
            assert found == [(name, 1.0)] * (1 + text.endswith(whole)), name
    # A copy with a foreign line in the middle that holds words of the license itself, one without its beginning, one in other order.
    apache = dict(whole_texts())["Apache-2.0"]
    lines = apache.splitlines()
    half = len(lines) // 2
    for changed in (
        "\n".join([*lines[:half], lines[-5], *lines[half:]]),
        "\n".join(lines[30:]),
        "\n".join(lines[half:] + lines[:half]),
    ):
        (found,) = scanner([before + changed + after])
        assert found[1] == "Apache-2.0" and found[4] >= 0.85
    # A run of five words at two places, and a template that is mostly one such run.
    for template in ("one two three four five six one two three four five seven", "a b c d e f " * 40 + "end"):
        (found,) = Scanner([("X", template)])([FILL + template + " " + FILL])
        assert found == (0, "X", len(FILL), len(FILL + template), 1.0)
    assert not Scanner([("X", apache)])([before + apache[: len(apache) * 7 // 10] + after]) and CONTAINED == 0.8


def test_a_text_of_very_many_notices_takes_linear_time():
    from gaugeline.llm.licenses import Scanner

    notice = TEMPLATES[3][1]
    part = notice + " " + FILL
    scanner = Scanner([("X", notice)])
    seconds = []
    for copies in (2_000, 20_000):
        begin = time.monotonic()
        found = scanner([part * copies])
        seconds.append(time.monotonic() - begin)
        assert [f[2] for f in found] == list(range(0, len(part) * copies, len(part)))
    assert seconds[1] < 25 * seconds[0] + 1
