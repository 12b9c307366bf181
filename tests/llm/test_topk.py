import math
import random

import numpy as np
import pytest

from tillroll.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, rank int, q int"
NAN, INF = float("nan"), float("inf")


def expected(rows, asked, k, scale=64.0):
    def whole(vector):
        if vector is None or any(x is None or not math.isfinite(x) for x in vector):
            return None
        return [math.floor(scale * float(np.float32(x))) for x in vector]

    held = [(i, whole(v)) for i, v in rows if i is not None]
    held = [(i, v) for i, v in held if v is not None]
    out = []
    for q, u in held:
        if asked(q):
            scored = [(min(max(sum(a * b for a, b in zip(u, v)), -(1 << 63)), (1 << 63) - 1), i) for i, v in held if i != q]
            best = sorted(scored, key=lambda p: (-p[0], p[1]))[:k]
            out += [(q, n, i, s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


def rows_of(seed, count, width=12):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(width)]) for i in range(count)]
    rows += [(1000 + i, list(rows[3][1])) for i in range(90)]  # ties
    return rows


ODD = [
    (2000, None), (2020, [None, 1.0]), (2040, [NAN, 1.0]), (2060, [INF, 1.0]), (None, [1.0]), (2080, []), (2100, [0.5]),
    (2120, [0.5] * 30), (2140, [0.0] * 12),
]


def test_a_floor_leaves_out_only_what_scores_less():
    rng = np.random.default_rng(8)
    vectors, queries = rng.integers(-9, 9, (400, 6)), rng.integers(-9, 9, (30, 6))
    ids, own = np.arange(400), np.arange(30)
    whole = topk.search_shard(queries, own, vectors, ids, 7)
    scores = queries @ vectors.T
    floors = [None if n % 3 == 0 else int(np.sort(scores[n])[-5]) for n in range(30)]
    some = topk.search_shard(queries, own, vectors, ids, 7, floors)
    reached = lambda hits: {h for h in hits if floors[h[0]] is None or h[2] >= floors[h[0]]}
    assert reached(some) == reached(whole) and all(scores[n, i] == s for n, i, s in some)


@pytest.mark.parametrize("options", [{}, {"block": 4, "shard": 37}])
def test_equals_brute_force(spark, options):
    rows = rows_of(1, 400) + ODD
    frame = spark.createDataFrame([(i, v, "x", 1, 1) for i, v in rows], SCHEMA).repartition(4)
    found = topk.top_k(frame.where("vec_id % 20 = 0"), frame, scale=64.0, k=20, **options)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect())
    assert got == expected(rows, lambda i: i % 20 == 0, 20)


def test_large_components_are_added_exactly(spark):
    rows = [(0, [1e18, -1.0, 3.0]), (1, [1.0, 1e17, 1.0]), (2, [-1e18, 2.0, 1e9]), (3, [5.0, 1e8, 1e30]), (20, [1e12, 1e3, 7.0])]
    frame = spark.createDataFrame([(i, v, "x", 1, 1) for i, v in rows], SCHEMA)
    found = topk.top_k(frame.where("vec_id % 20 = 0"), frame, scale=64.0, k=3)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect())
    assert got == expected(rows, lambda i: i % 20 == 0, 3)


def test_fewer_candidates_than_asked_for_and_empty_tables(spark):
    frame = spark.createDataFrame([(0, [1.0], "x", 1, 1), (5, [2.0], "x", 1, 1)], SCHEMA)
    assert [(r.vec_id, r["rank"]) for r in topk.top_k(frame.where("vec_id = 0"), frame).collect()] == [(5, 1)]
    assert topk.top_k(frame.where("vec_id = 0"), frame.where("vec_id = 0")).count() == 0
    assert topk.top_k(frame.limit(0), frame.limit(0)).count() == 0


def test_non_essential_terms_are_probed_for_few_vectors():
    rng = np.random.default_rng(6)
    vectors = np.floor(rng.normal(0, 8, (3000, 32)) * np.linspace(3, 0.2, 32))
    query = vectors[:1]
    best = topk.search_shard(query, np.array([0]), vectors, np.arange(3000), 5)
    scores = vectors @ query[0]
    scores[0] = -np.inf
    order = np.lexsort((np.arange(3000), -scores))[:5]
    assert [(i, s) for _, i, s in best] == [(int(i), int(scores[i])) for i in order]
