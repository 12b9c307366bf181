import random
import re

import pytest
from pyspark.sql import types as T

from tillroll.llm import secrets
from tillroll.llm.automata import compile_rules, longest

PIECES = [
    "password", "passwd", "Secret", "token", "api_key", "APIKEY", "=", ":", "==", " ", "  ", '"', "'", "abcdef", "abc",
    "0123456789abcdef" * 2, "AKIA", "ABCDEFGHIJ0123456789", "ghp_", "x" * 36, "é", "日本", "\n", "a.b/c+d",
    "-----BEGIN RSA PRIVATE KEY-----", "AIza", "-_" * 20, "😀",
]


def by_regex(text):
    found = []
    for number, (kind, rule, group, least) in enumerate(secrets.RULES):
        for match in re.finditer(rule, text):
            if len(match.group(group)) >= least:
                found.append((match.start(), number, kind, match.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    made = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(800)]
    return [*made, "", None, "0a" * 200_000, "password=token:abcdefgh", "ab cd " * 50_000 + "token: abcdef", made[0]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    schema = "doc_id long, text string, spans string, n_chars long"
    return spark.createDataFrame([(i, t, "x", len(t or "")) for i, t in enumerate(texts)], schema).repartition(3)


def test_spans_equal_the_regular_expressions(docs, texts):
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.scan_documents(docs).collect()}
    assert got == {i: by_regex(t or "") for i, t in enumerate(texts)}


def test_a_short_value_is_dropped_but_consumed(docs, texts):
    number = texts.index("password=token:abcdefgh")
    assert secrets.scan_documents(docs.where(f"doc_id = {number}")).first().spans == []


def test_redaction_removes_every_secret(docs, texts):
    out = {r.doc_id: r for r in secrets.redact_documents(docs).collect()}
    for i, text in enumerate(texts):
        found = by_regex(text or "")
        if text is None:
            assert out[i].text is None
        elif not found:
            assert out[i].text == text
        else:
            assert "[" in out[i].text
        assert out[i].n_chars == len(out[i].text or "")
        assert out[i].spans == "x"


def test_empty_table(spark):
    empty = spark.createDataFrame([], T._parse_datatype_string("doc_id long, text string"))
    assert secrets.scan_documents(empty).count() == 0
    assert secrets.redact_documents(empty).count() == 0


def test_automata_are_minimal_and_anchored():
    automaton = compile_rules(["ab+", "(?:ab|abb)b*"], search=False)
    assert len(automaton.step) == 4  # nothing, a, ab..., dead
    assert longest(automaton, b"abbbc", 0) == 4
    assert longest(automaton, b"ba", 0) == -1
