import random

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tillroll.llm import licenses

SCHEMA = "doc_id long, text string, start string, license int, f string"


def filler(rng, n=30):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    rows = []
    for number, (_, text) in enumerate(licenses.TEMPLATES):
        rows.append((number, f"{filler(rng)} {text}\n{filler(rng)}"))
        changed = text.split()
        if len(changed) > 12:
            middle = len(changed) // 2
            changed[next(k for k in range(middle, 0, -1) if not any(map(licenses.defining, licenses._words(changed[k]))))] = "changed"
            rows.append((100 + number, f"{filler(rng)}\n{' '.join(changed)} {filler(rng)}"))
    rows += [(500, ""), (501, None), (502, filler(rng)), (503, "The driving licence office gave no permission to copy."), (0, rows[0][1])]
    rows.append((504, filler(rng, 60_000) + "\n" + licenses.TEMPLATES[0][1]))
    return spark.createDataFrame([(i, t, "clash", 1, "clash") for i, t in rows], SCHEMA).repartition(3)


def test_findings(docs):
    got: dict = {}
    for r in licenses.scan_licenses(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    for number, (name, text) in enumerate(licenses.TEMPLATES):
        found = got[number]
        assert {f.license for f in found} == {name} and found[0].wording == "exact" and not found[0].differences
        assert len(found) == (2 if number == 0 else 1)  # row 0 is repeated
        if 100 + number in got:
            assert got[100 + number][0].wording == "variant"
            assert any("changed" in d for d in got[100 + number][0].differences)
    assert {n for n in range(len(licenses.TEMPLATES)) if len(licenses.TEMPLATES[n][1].split()) > 12} == {i - 100 for i in got if 100 <= i < 500}
    assert set(got) & set(range(500, 504)) == set()
    assert got[504][0].license == "MIT"


def test_spans_and_ranking_equal_a_direct_search(docs):
    import zstandard

    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in licenses.scan_licenses(docs).collect():
        block = texts[r.doc_id][r.start : r.end].encode()
        plain = len(zstandard.ZstdCompressor(level=3).compress(block))
        sizes = []
        for _, text in licenses.TEMPLATES:
            primed = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            sizes.append(len(zstandard.ZstdCompressor(level=3, dict_data=primed).compress(block)))
        assert r.template == sizes.index(min(sizes)) and abs(r.reduction - (plain - min(sizes)) / plain) < 1e-12


def test_differences_name_the_wording():
    template, block = "a b c d e f g h i j".split(), "x a b c q e f g h i j y".split()
    assert licenses.differences(template, block) == ("variant", ["d -> q"])
    assert licenses.differences(template, ["z", *template, "z"]) == ("exact", [])
    assert licenses.differences(template, ["a", "z"])[0] == "other"


def found_in(text):
    return [(text[f["start"] : f["end"]], f["license"], f["wording"]) for f in licenses.findings_of(text)]


def test_every_notice_of_a_block_is_found():
    apache, mit, cc = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "Licensed under CC BY 4.0."
    named = {apache: "Apache-2.0", mit: "MIT", cc: "CC-BY-4.0"}
    assert found_in(f"{apache}\n{mit}") == [(apache, "Apache-2.0", "exact"), (mit, "MIT", "exact")]
    texts = [apache, mit, "Nothing here.", cc, mit, mit, apache]
    assert found_in(" ".join(texts)) == [(t, named[t], "exact") for t in texts if t in named]
    later = [(t, name, "exact") for name, t in licenses.TEMPLATES if name.startswith("GPL") and name.endswith("later")]
    assert len(later) == 4 and found_in("\n".join(t for t, *_ in later)) == later
    changed = [t.replace("redistribute it", "share it") for t, _, _ in later[:2]]
    assert found_in(" ".join(changed)) == [(changed[0], "GPL-3.0-or-later", "variant"), (changed[1], "GPL-2.0-or-later", "variant")]


def test_all_templates_in_one_block():
    text = "\n".join(t for _, t in licenses.TEMPLATES)
    assert [(f["template"], f["wording"]) for f in licenses.findings_of(text)] == [(n, "exact") for n in range(len(licenses.TEMPLATES))]


def test_a_longer_template_that_ranks_first_hides_no_exact_one():
    cc = "Licensed under CC BY 4.0."
    assert found_in(f"{cc} This program is free software under the terms of its License.") == [(cc, "CC-BY-4.0", "exact")]


def test_empty_table(docs):
    assert licenses.scan_licenses(docs.limit(0)).count() == 0
    assert docs.select(licenses.findings(F.col("text"))).limit(0).count() == 0


NO_SUCH = [
    ("Released under the BSD License.", "BSD"),
    ("Released under the ISC License.", "ISC"),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    (licenses.TEMPLATES[6][1].replace("GNU General", "GNU Affero General"), "AGPL-3.0-or-later"),
    (licenses.TEMPLATES[7][1].replace("program", "library").replace("GNU General", "GNU Lesser General").replace("version 2 ", "version 2.1 "), "LGPL-2.1-or-later"),
    ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
    ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"),
    ("Licensed under CC BY 3.0.", "CC-BY-3.0"),
    ("Not released under the MIT License.", None),
    ("This is not, and never was, released under the MIT License.", None),
    ("Released under the Foo License.", None),
    ("Released under the BSD-MIT License.", None),
    ("Licensed under CC BY 2.0.", None),
    ("It is not free. Released under the MIT License.", "MIT"),
]


@pytest.mark.parametrize("text,name", NO_SUCH)
def test_each_license_by_its_own_name(text, name):
    assert [f["license"] for f in licenses.findings_of(f"Some words here.\n{text} And more of them.")] == ([name] if name else [])


@pytest.mark.parametrize("number", range(len(licenses.TEMPLATES)))
def test_near_misses_by_one_defining_word_are_refused(number):
    """Every defining word left out, replaced by another, and every place between words with a negation put in."""
    name, text = licenses.TEMPLATES[number]
    parts = [p for p in licenses.re.split(r"(\w+)", text)]
    at = [k for k in range(1, len(parts), 2) if licenses.defining(parts[k].lower())]
    for k in at:
        other = "7" if parts[k].isdigit() else "zlib"
        for put in (other, ""):
            near, place = "".join([*parts[:k], put, *parts[k + 1 :]]), len("".join(parts[:k]))
            # what may remain is a shorter notice of the same license that ends before the change or begins behind it
            assert not [f for f in licenses.findings_of(near) if f["license"] == name and f["start"] <= place < f["end"]], near
            assert number == 4 or name not in [f["license"] for f in licenses.findings_of(near)], near
    for k in range(3, len(parts), 2):
        near = "".join([*parts[:k], "never ", *parts[k:]])
        found = [f for f in licenses.findings_of(near) if f["license"] == name]
        assert not any("never" in near[f["start"] : f["end"]] for f in found), near


def test_no_notice_of_the_documents_is_missed(spark):
    """All word sequences of all templates, looked for directly in all documents."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found: dict = {}
    for r in licenses.scan_licenses(docs).collect():
        found.setdefault(r.doc_id, []).append(r)
    seen = 0
    for r in docs.collect():
        text = r.text or ""
        spans = [m.span() for m in licenses._WORD.finditer(text)]
        words = [text[a:b].lower() for a, b in spans]
        for _, template in licenses.TEMPLATES:
            wanted = licenses._words(template)
            for at in licenses._occurrences(wanted, words):
                if not licenses._negated(text, spans, words, at):
                    seen += 1
                    assert any(f.start <= spans[at][0] and f.end >= spans[at + len(wanted) - 1][1] for f in found[r.doc_id])
    assert seen
