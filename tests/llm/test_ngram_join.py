import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillroll.llm import ngram_join, shingles
from tillroll.llm.components import components

SCHEMA = "doc_id long, text string, lang string, n long, class_id string"


def words(text):
    return re.findall(r"(?:[A-Za-z0-9_]|[^\x00-\x7f])+", (text or "").lower())


def sets(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_force(texts):
    """(class, links) by number of the text."""
    held = [sets(t) for t in texts]
    similar = lambda a, b: a == b or (a and b and len(a & b) / len(a | b) >= 0.8)
    near = [[j for j in range(len(held)) if j != i and similar(held[i], held[j])] for i in range(len(held))]
    root = list(range(len(held)))
    for _ in held:
        root = [min([root[i], *(root[j] for j in near[i])]) for i in range(len(held))]
    return root, [len(x) for x in near]


def made(seed=3, count=260):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghéß") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(25)]
    texts: list[str | None] = ["", None, " \n.", "one two", "one two", "One, two!", "one two three four five six"]
    while len(texts) < count:
        if rng.random() < 0.4 and len(texts) > 20:
            base = words(rng.choice(texts[7:])) or ["x"]
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
        else:
            body = [rng.choice(vocabulary) for _ in range(rng.randint(1, 90))]
            texts.append(" ".join(passage + body if rng.random() < 0.4 else body))
    texts.append(" ".join(rng.choice(vocabulary) for _ in range(60_000)))
    return texts


@pytest.fixture(scope="module")
def texts():
    return made()


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", 1, "clash") for i, t in enumerate(texts)], SCHEMA).repartition(3)


@pytest.mark.parametrize("options", [{}, {"limit": 8, "block": 3}])
def test_equals_brute_force(docs, texts, options):
    got = {r.doc_id: r for r in ngram_join.similar_documents(docs, **options).collect()}
    classes, links = brute_force(texts)
    assert {i: r.class_id for i, r in got.items()} == dict(enumerate(classes))
    if options:  # with tiny buckets the paths are long, and a few pairs of low similarity may be missed
        found = sum(r.n_links for r in got.values())
        assert 0.95 * sum(links) <= found <= sum(links)
    else:
        assert {i: r.n_links for i, r in got.items()} == dict(enumerate(links))


def test_runs_are_repeated_until_the_recall_is_reached(spark):
    """Pairs just above the threshold among documents that share most shingles with all others."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(8))
    shared, texts = [word() for _ in range(60)], []
    for _ in range(60):
        own = [word() for _ in range(40)]
        copy = shared + own
        copy[95:] = [word() for _ in range(5)]
        copy[63] = word()
        texts += [" ".join(shared + own), " ".join(copy)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    _, links = brute_force(texts)
    assert set(links) == {1}
    found = ngram_join.similar_documents(docs, runs=3, limit=4).agg(F.sum("n_links")).first()[0]
    assert found >= 0.95 * sum(links)  # three runs alone find fewer


def test_needed_runs():
    one = [ngram_join.meeting(d, 0.8, 64, 1) for d in range(1, 6)]
    assert [round(p, 2) for p in one] == [0.64, 0.47, 0.38, 0.32, 0.27]
    needs = [ngram_join.needed_runs(d, 0.8, 64, 0.95) for d in range(1, 14)]
    assert needs == sorted(needs) and needs[3] <= ngram_join.RUNS < needs[5]
    for depth, runs in enumerate(needs, 1):
        assert ngram_join.meeting(depth, 0.8, 64, runs) >= 0.95 > ngram_join.meeting(depth, 0.8, 64, runs - 1)
    with pytest.raises(ValueError):
        ngram_join.needed_runs(3, 0.8, 64, 1.0)


def test_one_document_of_each_class_stays(docs, texts):
    classes, _ = brute_force(texts)
    out = ngram_join.deduplicated(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(classes))


def test_rows_grow_with_the_group_and_not_with_its_square(spark, monkeypatch):
    """Near copies of one text, all different: no table that the join writes has more rows per set in larger groups."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(100)]

    def copy():
        text = list(base)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(100)] = word()
        return " ".join([*text, word()])

    texts, per_set = [copy() for _ in range(1200)], {}
    held = [sets(t) for t in texts]
    near = [[j for j in range(i) if len(held[i] & held[j]) / len(held[i] | held[j]) >= 0.8] for i in range(len(held))]
    real = ngram_join.written
    for n in (300, 1200):
        rows, links, root = per_set.setdefault(n, {}), [0] * n, list(range(n))

        def counted(df, label):
            out = real(df, label)
            rows[label] = rows.get(label, 0) + out.count() / n  # noqa: B023
            return out

        monkeypatch.setattr(ngram_join, "written", counted)
        docs = spark.createDataFrame(list(enumerate(texts[:n])), "doc_id long, text string").repartition(3)
        got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.similar_documents(docs, limit=64).collect()}
        for i in range(n):
            links[i] += len(near[i])
            for j in near[i]:
                links[j] += 1
                old, new = sorted((root[i], root[j]), reverse=True)
                root = [new if r == old else r for r in root] if old != new else root
        assert got == {i: (root[i], links[i]) for i in range(n)}
    small, large = per_set[300], per_set[1200]
    # a set has a row in each of its buckets, and at most one where it has a partner that no earlier bucket has shown it
    assert large.pop("path-candidates") <= large["path-leaves"]
    for label, rows in large.items():
        assert rows <= 1.2 * small.get(label, 0) + 0.05, label


def test_of_rows_with_one_id_the_choice_is_fixed(spark):
    rows = [(1, "a b c d e f", lang, n, "x") for lang in ("en", "de", None) for n in (1, 2, None)] * 2 + [(1, "a b c d e f.", "fr", 3, "x")]
    docs = [spark.createDataFrame(rows[k:] + rows[:k], SCHEMA).repartition(1 + k) for k in (0, 3, 7)]
    kept = [ngram_join.deduplicated(d.withColumn("m", F.create_map(F.lit("k"), "n"))).collect() for d in docs]
    assert len(kept[0]) == 1 and kept[0] == kept[1] == kept[2]


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c d e f", "en", 1, ""), (1, "a b c d e f", "en", 1, ""), (None, "a b c d e f", "en", 1, ""), (2, "q r s", "en", 1, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.doc_id or 0, r.class_id, r.n_links) for r in ngram_join.similar_documents(docs).collect())
    assert got == [(0, 1, 2), (1, 1, 2), (1, 1, 2), (2, 2, 0)]
    assert sorted(r.doc_id for r in ngram_join.deduplicated(docs).collect()) == [1, 2]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ngram_join.similar_documents(empty).count() == 0
    assert ngram_join.deduplicated(empty).count() == 0


def test_shingles_do_not_depend_on_the_batch():
    texts = made(9, 40)
    hashes, bounds = shingles.shingle_sets(texts)
    for i, text in enumerate(texts):
        own = hashes[bounds[i] : bounds[i + 1]]
        assert len(own) == len(sets(text))
        assert np.array_equal(own, shingles.shingle_sets([text])[0])
    long = "ab cd " * 400_000
    assert len(shingles.shingle_sets([long])[0]) == 2
    assert len(shingles.shingle_sets(["x" * 3_000_000])[0]) == 1


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(400 + i, 401 + i) for i in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {v: v for e in edges for v in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    for v in root:
        while root[v] != root[root[v]]:
            root[v] = root[root[v]]
    loose = {a for a, b in edges if a == b} - {v for a, b in edges if a != b for v in (a, b)}
    assert got == {v: r for v, r in root.items() if v not in loose}


def test_a_group_that_fills_a_whole_batch():
    frame = pd.DataFrame({
        "key": [1, 1], "i": [0, 0], "j": [0, 0], "set": [3, 5], "copies": [1, 2],
        "tokens": [np.arange(9, dtype=np.uint64).tobytes()] * 2, "partners": [[5], []],
    })
    for cut in (1, 2):  # a batch without the end of a group, or with one group only
        parts = list(ngram_join._verified(0.8)(iter([frame[:cut], frame[cut:], frame.assign(key=2)])))
        got = pd.concat(parts, ignore_index=True)
        assert got.to_dict("list") == {"set": [3, 5] * 2, "root": [3, 3] * 2, "links": [2, 1] * 2}
