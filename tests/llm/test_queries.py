"""The registered queries on the given tables: against SQL, or against what a check outside Spark computes."""

import re
from collections import defaultdict

import corpus_pipeline
import duckdb
import pytest
from compare import difference
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillroll.llm import mixing, packing, secrets
from tillroll.llm.queries import LLM_ORACLE, LLM_QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    held = duckdb.connect()
    for table in TABLES:
        held.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    return held


@pytest.fixture(scope="module")
def texts(db):
    return dict(db.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


def test_the_entry_registers_them():
    assert set(LLM_QUERIES) <= set(entry.queries()) and set(LLM_ORACLE) <= set(entry.oracle_sql())
    assert set(LLM_ORACLE) <= set(LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_matches_sql(spark, db, name):
    assert difference(LLM_QUERIES[name](spark, SMALL), db, LLM_ORACLE[name]) is None


@pytest.mark.parametrize("name", ["op7_chat_format", "op9_fingerprints"])
def test_native_queries_run_no_python(spark, name):
    plan = LLM_QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_secret_counts(spark, texts):
    rows = LLM_QUERIES["op1_secret_scan"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        for kind, rule, group, least in secrets.BASE_RULES:
            assert r[f"n_{kind}"] == sum(len(m.group(group)) >= least for m in re.finditer(rule, texts[r.doc_id]))


def test_documents_are_packed_whole(spark, texts):
    rows = LLM_QUERIES["op3_best_fit_packing"](spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(texts)
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= packing.LENGTH


def test_mix_comes_near_its_targets(spark, texts):
    rows = LLM_QUERIES["op8_source_mix"](spark, SMALL).collect()
    taken = defaultdict(int)
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])) and 0 <= r.taken <= 3 * r.size
        taken[r.target, r.source_size] += r.taken
    assert abs(sum(t for t, _ in taken) - sum(r.size for r in rows)) < 1e-3
    longest = max(r.size for r in rows)
    assert all(abs(words - target) <= longest for (target, _), words in taken.items())


def test_the_stages_do_what_they_say(spark, texts):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["drop_toxic", "drop_near_duplicates", "redact_secrets", "mix_sources", "pack_sequences"]
    toxic, near, redact, mix, pack = [f for _, f in corpus_pipeline.STAGES]

    left = toxic(spark, docs, SMALL)
    assert left.columns == docs.columns and 0.8 * len(texts) < left.count() <= len(texts)

    kept = near(spark, docs, SMALL)
    ids = [r.doc_id for r in kept.collect()]
    classes = {r.doc_id: r.class_id for r in LLM_QUERIES["op10_ngram_join"](spark, SMALL).collect()}
    assert kept.columns == docs.columns and sorted(ids) == sorted(set(classes.values()))

    clean = redact(spark, docs, SMALL)
    assert clean.columns == docs.columns and clean.count() == len(texts)
    assert secrets.scan_documents(clean).where(F.size("spans") > 0).count() == 0

    mixed = mix(spark, docs, SMALL)
    sizes = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    wanted = mixing.mix(docs, mixing.n_words("text"), F.array("source"), F.col("doc_id"))
    assert mixed.columns == docs.columns
    assert sizes == {r.doc_id: len(r.mix_copies) for r in wanted.collect() if r.mix_copies}

    assert {r.doc_id for r in pack(spark, docs, SMALL).collect()} == set(texts)


def test_the_pipeline_runs(spark):
    rows = LLM_QUERIES["pipeline"](spark, SMALL).collect()
    assert rows and {r.piece for r in rows if r.start == 0} == {0}
