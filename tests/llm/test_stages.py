"""All stages of the pipeline on tables of odd rows, one after the other and each on its own."""

import random

import corpus_pipeline
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

KIND = "doc_id long, text string, lang string, source string, n_chars long, mix_copy string, id string, score string, doc int, `class_id` map<string,int>"


def odd(spark):
    """Nulls in every column, empty texts, one of 60,000 words, copies of one text, repeated rows and ids, columns with names of ours."""
    rng = random.Random(11)
    say = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n))
    more = ("copy", "x", None, 3, {"k": 1})
    rows = [(i, say(30 + i % 7), "en", "ab"[i % 2], 9, *more) for i in range(60)]
    rows += [(None, None, None, None, None, None, None, None, None, None)] * 2
    rows += [(100, "", "en", "a", 0, *more), (101, None, "en", None, None, *more), (102, " \n\t", "de", "b", 3, *more)]
    rows += [(103, say(60_000), "en", "a", 1, *more), (104, rows[0][1], "en", "b", 1, *more), (104, rows[0][1], "fr", "b", 1, *more)]
    rows += [rows[3], rows[3], (105, "password = abcdefgh12345 " + say(20), None, "b", 1, *more)]
    return spark.createDataFrame(rows, KIND).repartition(5)


def content(frame):
    """Rows as text, without the map, which has no order."""
    return sorted(map(str, frame.withColumn("class_id", F.to_json("class_id")).collect()))


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_a_stage_keeps_columns_and_takes_odd_rows(spark, name, stage):
    docs = odd(spark)
    out = stage(spark, docs, SMALL)
    assert out.schema.simpleString() == docs.schema.simpleString()
    before, after = content(docs), content(out)
    assert after == content(stage(spark, docs.repartition(2), SMALL))  # however the rows are dealt
    if name == "secrets":
        assert len(after) == len(before)
        changed = [r for r in out.collect() if r.text is not None and "abcdefgh12345" in r.text]
        assert not changed and out.where("text IS NULL").count() == docs.where("text IS NULL").count()
    else:
        assert set(after) <= set(before)
    if name == "toxicity":
        assert len(after) > 0.9 * len(before)
    if name == "near duplicates":
        texts = [r.text or "" for r in out.collect()]
        assert len({t.strip() for t in texts}) == len(texts)  # one of the wordless texts, and one of each other text
        assert {r.doc_id for r in out.where("text <> ''").collect()} >= set(range(1, 60)) - {0}
    if name == "mixing":
        assert out.where("text IS NULL OR trim(text) = ''").count() == 0
    assert stage(spark, docs.where("false"), SMALL).count() == 0


def test_the_last_stage_takes_odd_rows(spark):
    docs = odd(spark)
    pack = corpus_pipeline.STAGES[-1][1]
    rows = pack(spark, docs, SMALL).collect()
    whole = sum(r.length for r in rows)
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))] and sum(n for _, n in places) <= 2048
    assert sum(1 for r in rows if r.piece == 0) == docs.count() and whole > 60_000
    assert pack(spark, docs.where("false"), SMALL).count() == 0
