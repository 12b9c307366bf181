import random

import pytest
from pyspark.sql import functions as F

from tillroll.llm import fingerprints

SCHEMA = "doc_id long, text string, lanes string, next_text string, s int, fingerprint int"


def shingles(text):
    words = [w for w in (text or "").translate(dict.fromkeys(map(ord, "\t\n\x0b\x0c\r"), " ")).split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    vocabulary = [f"w{i}é" for i in range(500)]
    made = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 400))) for _ in range(120)]
    made[5] = made[4]
    made[6] = made[4] + " some more words"
    return [*made, "", None, " \n\t", "one two", "x" * 5000, " ".join(rng.choices(vocabulary, k=40_000))]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(3 * i, t, "clash", "clash", 1, 1) for i, t in enumerate(texts)], SCHEMA).repartition(4)


def test_neighbours_and_edits(docs, texts):
    got = {r.doc_id: r for r in fingerprints.neighbours(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        text, following = text or "", texts[(i - 1) % len(texts)] or ""
        third = len(text) // 3
        assert got[3 * i].n_chars == len(text)
        assert got[3 * i].edited == text[: len(text) - third] + following[:third]


def test_likeness_is_near_the_similarity(docs, texts):
    rows = fingerprints.neighbours(docs)
    near = rows.select(
        "doc_id", "edited", fingerprints.likeness(F.col("lanes"), F.col("edited_lanes")).alias("e"), fingerprints.likeness(F.col("lanes"), F.col("next_lanes")).alias("n")
    ).collect()
    errors = []
    for r in near:
        i = r.doc_id // 3
        errors.append(r.e - similarity(texts[i], r.edited))
        errors.append(r.n - similarity(texts[i], texts[(i - 1) % len(texts)]))
        assert 0 <= r.e <= 1 and 0 <= r.n <= 1
    assert max(map(abs, errors)) < 0.16 and abs(sum(errors) / len(errors)) < 0.01


def test_equal_texts_have_equal_fingerprints(docs, texts):
    got = {r.doc_id // 3: r.fingerprint for r in fingerprints.fingerprints(docs).collect()}
    assert got[4] == got[5] != got[6]
    assert {len(f) for f in got.values()} == {0, fingerprints.BINS * fingerprints.BITS // 4}
    assert sorted(i for i, f in got.items() if not f) == [i for i, t in enumerate(texts) if not shingles(t)]


def test_no_python_in_the_plan(docs):
    plan = fingerprints.neighbours(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("ids", [[], [5], [1, 1, 1], [None, 4, 9], [-(1 << 63), (1 << 63) - 1, 0]])
def test_few_rows(spark, ids):
    docs = spark.createDataFrame([(i, f"text {n} of a few words", "", "", 1, 1) for n, i in enumerate(ids)], SCHEMA)
    rows = fingerprints.neighbours(docs).collect()
    assert len(rows) == len(ids)
