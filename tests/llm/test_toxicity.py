import random
import zlib

import pytest

from tillroll.llm import toxicity

SCHEMA = "doc_id long, text string, score string, features string, label int, id string"
BAD = ["blork", "zanfel", "quippa"]


def made(count, seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    docs, labels = [], []
    for i in range(count):
        toxic = int(rng.random() < 0.2)
        body = [rng.choice(vocabulary) for _ in range(rng.randint(20, 80))]
        for _ in range(rng.randint(2, 6) if toxic else rng.random() < 0.01):
            body.insert(rng.randrange(len(body)), rng.choice(BAD) + rng.choice(["", "s", "ed"]))
        docs.append((i, " ".join(body), "clash", "clash", 7, "clash"))
        labels.append((i, toxic))
    docs += [(count, "", "", "", 0, ""), (count + 1, None, "", "", 0, ""), (None, "blork blork", "", "", 0, ""), (0, "repeated id", "", "", 0, ""), (count + 2, "word " * 60_000, "", "", 0, "")]
    return docs, labels + [(5, None), (None, 1)]


@pytest.fixture(scope="module")
def data(spark):
    docs, labels = made(1500)
    return spark.createDataFrame(docs, SCHEMA).repartition(4), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


@pytest.fixture(scope="module")
def model(data):
    docs, labels, _ = data
    return toxicity.fit(docs, labels.where(~toxicity.held_out("doc_id")))


def test_held_out_accuracy(data, model):
    docs, _, truth = data
    rows = model.score(docs).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.doc_id is not None and 0 < r.doc_id < 1500 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1 and truth[r.doc_id] is not None]
    right = sum((r.score >= toxicity.REJECT) == bool(truth[r.doc_id]) for r in held)
    assert right >= 0.95 * len(held)
    assert all(r.features == "clash" for r in rows if r.label == 7)


def test_the_lexicon_holds_what_stands_in_toxic_texts(model):
    assert set(BAD) <= model.lexicon.strong
    assert model.lexicon.kind("blorkish") == 2 and model.lexicon.kind("abc") == 0


def test_held_out_rows_are_those_of_the_checksum(spark):
    rows = spark.range(200).select("id", toxicity.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)


def test_toxic_documents_go(data):
    docs, labels, truth = data
    out = toxicity.without_toxic(docs, labels)
    assert out.columns == docs.columns
    left = [r.doc_id for r in out.collect()]
    assert None not in left and sum(bool(truth.get(i)) for i in left) < 0.05 * sum(map(bool, truth.values()))
    assert len(left) >= 0.95 * (docs.count() - sum(map(bool, truth.values())))


def test_nothing_to_learn_from(data):
    docs, labels, _ = data
    clean = toxicity.fit(docs, labels.where("toxic = 0"))
    assert {r.score for r in clean.score(docs).collect()} == {0.0}
    assert toxicity.fit(docs.limit(0), labels).score(docs.limit(0)).count() == 0
    assert {r.score for r in toxicity.fit(docs, labels.limit(0)).score(docs).collect()} == {0.0}


def test_features_of_odd_texts():
    kinds = toxicity._kinds(toxicity.Lexicon(frozenset({"idiot"}), frozenset()))
    names = toxicity.FEATURES
    assert all(v == 0 for v in toxicity.feature_row("", kinds))
    row = dict(zip(names, toxicity.feature_row("YOU IDIOT!! 1d10t id1ot sooo", kinds)))
    assert row["strong_count"] > 0 and row["near_you"] == 1 and row["masked_strong"] >= 1 and row["capitals"] > 0 and row["stretched"] > 0


def test_shouted_words_count_in_long_texts():
    kinds = toxicity._kinds(toxicity.Lexicon(frozenset(), frozenset()))
    row = dict(zip(toxicity.FEATURES, toxicity.feature_row("word " * 1000 + "IDIOT " * 100, kinds)))
    assert row["shouted"] == 100 / 1100
