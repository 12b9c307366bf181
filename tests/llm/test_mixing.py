import itertools
import random

import duckdb
from pyspark.sql import functions as F

from tillroll.llm import mixing
from tillroll.llm.expressions import hashable

SCHEMA = "doc_id long, text string, source string, plan string, mix_size string"


def cost(flow, capacity):
    """The sum over all words of how often they were taken before."""
    total = 0
    for pattern, shares in flow.items():
        used, size = sum(shares.values()), capacity[pattern]
        laps, rest = divmod(used, size)
        total += size * laps * (laps - 1) // 2 + rest * laps
    return total


def test_flow_against_all_flows():
    rng = random.Random(4)
    for _ in range(40):
        patterns = [("a",), ("b",), ("a", "b")][: rng.randint(1, 3)]
        capacity = {p: rng.randint(1, 3) for p in patterns}
        quota = {"a": rng.randint(0, 7), "b": rng.randint(0, 7)}
        got = mixing.least_cost_flow(capacity, quota, repeats=3)
        arcs = [(p, s) for p in patterns for s in p]
        best = None
        for words in itertools.product(range(8), repeat=len(arcs)):
            flow = {p: {} for p in patterns}
            for (p, s), w in zip(arcs, words):
                flow[p][s] = w
            if any(sum(f.values()) > 3 * capacity[p] for p, f in flow.items()):
                continue
            if any(sum(f.get(s, 0) for f in flow.values()) > quota[s] for s in quota):
                continue
            key = (-sum(words), cost(flow, capacity))
            best = key if best is None or key < best else best
        assert all(sum(f.values()) <= 3 * capacity[p] for p, f in got.items())
        assert all(sum(f.get(s, 0) for f in got.values()) <= quota[s] for s in quota)
        assert (-sum(sum(f.values()) for f in got.values()), cost(got, capacity)) == best


def test_targets_share_by_weight_and_stop_at_three_times_the_size():
    got = mixing.targets({"b": 1000, "a": 10, None: 1000, "c": 1000})
    assert got["a"] == 30  # weight 1 of 3010 / 7 is above 30
    left = 3010 - 30
    assert [round(got[s], 6) for s in ("b", "c", None)] == [round(left * w / 6, 6) for w in (2, 3, 1)]
    assert mixing.targets({}) == {}
    assert mixing.targets({"a": 0, "b": 5})["a"] == 0


def made(spark, n=3000):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        source = rng.choice(["s0", "s0", "s0", "s1", "s2", "é", None])
        rows.append((i, "w " * rng.randint(0, 60) if i % 50 else None, source, "clash", "clash"))
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def mixed(docs):
    found = mixing.mix(docs, mixing.n_words("text"), F.array("source"), F.col("doc_id"))
    return {(r.doc_id): (r.source, r.mix_size, len(r.mix_copies), r.plan) for r in found.collect()}


def test_every_source_comes_near_its_target(spark):
    docs = made(spark)
    got = mixed(docs)
    assert len(got) == 3000 and {v[3] for v in got.values()} == {"clash"}
    sizes, taken = {}, {}
    for source, size, copies, _ in got.values():
        sizes[source] = sizes.get(source, 0) + size
        taken[source] = taken.get(source, 0) + size * copies
        assert copies <= 3 and (size or not copies)
    for source, target in mixing.targets(sizes).items():
        assert abs(taken[source] - target) <= 60
    assert got == mixed(docs.repartition(2))  # reruns agree, however the rows are dealt


def test_the_mix_repeats_documents(spark):
    docs = made(spark, 400)
    got = mixed(docs)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {i: v[2] for i, v in got.items() if v[2]}


def test_reruns_agree_where_ids_repeat_or_are_missing(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 2, 3, i]), "w " * rng.randint(1, 40), rng.choice("ab"), str(rng.randrange(3)), "x") for i in range(3000)]
    docs, got = spark.createDataFrame(rows, SCHEMA), []
    for parts in (1, 2, 7):
        found = mixing.mix(docs.repartition(parts), mixing.n_words("text"), F.array("source"), F.col("doc_id")).collect()
        got.append(sorted((str(r.doc_id), r.text, r.source, r.mix_size, r.plan, len(r.mix_copies)) for r in found))
    assert got[0] == got[1] == got[2]
    place = docs.where("doc_id IS NULL").select(F.pmod(F.shiftright(F.xxhash64(F.lit(17), F.col("doc_id"), *hashable(docs)), 20), F.lit(mixing.SLICES)).alias("s"))
    counts = place.groupBy("s").count().agg(F.max("count"), F.sum("count")).first()
    assert counts[0] < 0.05 * counts[1]  # rows without an id are no slice of their own


def test_columns_keep_their_names_and_values(spark):
    rows = [(i, "w " * 9, "ab"[i % 2], "size", {"k": i}, 0.5) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_size string, mix_copy map<string,int>, `mix_copies` double")
    out = mixing.mixed_documents(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    kept = out.collect()
    assert kept and all(r.mix_size == "size" and r.mix_copy == {"k": r.doc_id} and r.mix_copies == 0.5 for r in kept)


def test_a_source_without_words_keeps_its_weight(spark):
    rows = [(i, "w " * 10, s, "", "") for i, s in enumerate("bcd" * 100)]
    rows += [(1000, None, "a", "", ""), (1001, " \n", "a", "", ""), (1002, "", "bb", "", "")]
    got = mixed(spark.createDataFrame(rows, SCHEMA))
    taken = dict.fromkeys(("a", "b", "bb", "c", "d"), 0)
    for source, size, copies, _ in got.values():
        taken[source] += size * copies
    wanted = mixing.targets({"a": 0, "b": 1000, "bb": 0, "c": 1000, "d": 1000})
    assert all(abs(taken[s] - wanted[s]) <= 20 for s in wanted)
    assert [round(wanted[s] / wanted["c"], 6) for s in ("b", "c", "d")] == [2, 1, 2]


def test_overlapping_sources(spark):
    rows = [(i, "w " * 10, s) for i, s in enumerate([["a"], ["a", "b"], ["b"], ["b", "a"]] * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    found = mixing.mix(docs, mixing.n_words("text"), F.col("sources"), F.col("doc_id")).collect()
    words = {"a": 0, "b": 0}
    for r in found:
        for copy in r.mix_copies:
            assert copy.source in r.sources
            words[copy.source] += r.mix_size
    assert abs(words["a"] - 2000 / 3) <= 20 and abs(words["b"] - 4000 / 3) <= 20


def test_empty_and_wordless_tables(spark):
    assert mixing.mixed_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    blank = spark.createDataFrame([(1, " \n", "a", "", ""), (2, None, None, "", "")], SCHEMA)
    assert mixing.mixed_documents(blank).count() == 0


def test_words_are_runs_between_ascii_blanks(spark):
    texts = ["a b", "a b", "\x0b\x0c x\r\ny\t", "", None, "\x1cq"]
    got = [r.n for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string").orderBy("i").select(mixing.n_words("text").alias("n")).collect()]
    sql = "SELECT len(regexp_extract_all(coalesce(?, ''), '[^\\x20\\x09-\\x0D]+'))"
    assert got == [duckdb.execute(sql, [t]).fetchone()[0] for t in texts]
