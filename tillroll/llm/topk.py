"""Exact top-k search by inner product over integer vectors, with MaxScore in shards.

The terms of a query are its components. In a shard each term has a posting list, the component of every vector, and a
bound, the largest product with the query's own component; the smallest product is the offset, so that contributions
count from zero. A query orders its terms by how much they can contribute. Terms at the end whose contributions together
cannot lift a vector over the threshold are non-essential. The essential postings are traversed for all vectors of the
shard; the others are probed, term by term, only for vectors whose sum and remaining bounds still reach the threshold: the
k-th best score that the query has in the first shard, or among the vectors of this shard that are best by its strongest
terms, whichever is more. The best k of every shard are merged.

Vectors are dealt to shards, and queries to blocks, by hashes of the rows, so rows of one id are spread. A block holds as many
queries as ``BLOCK_BYTES`` takes, and meets every shard once: every vector is moved once per block, with 64 dimensions
once for every 16,384 queries. The first shard is searched first, and its results are written.
Scores are exact: numbers too large for floating-point sums are added as integers, and scores outside 64 bits are set to
the nearest number inside. Null vectors and ids, and vectors that hold null or non-finite components, take no part; a
vector that is shorter than another counts as zero where it ends. A row is no candidate of a query with its own id, nor
are other rows with that id; of queries with one id each is answered by itself. Ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.staging import written

TOP = 20
BLOCK_BYTES = 8 << 20  # of queries
SHARD = 8192  # vectors
_PRUNE = 4  # terms probed between two prunings
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def valid(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad)


def _exact(queries: np.ndarray, vectors: np.ndarray) -> type:
    """The fastest number type in which all sums are exact."""
    most = max(float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * queries.shape[1], 1.0)
    return np.float32 if most < 1 << 23 else np.float64 if most < 1 << 52 else object


def _matrix(rows, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _cast(matrix: np.ndarray, kind: type) -> np.ndarray:
    if kind is object:
        return np.array([[int(x) for x in row] for row in matrix], dtype=object).reshape(matrix.shape)
    return matrix.astype(kind)


def _kth(scores: np.ndarray, k: int):
    if len(scores) < k:
        return None
    return np.sort(scores)[-k] if scores.dtype == object else np.partition(scores, len(scores) - k)[len(scores) - k]


def search_shard(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, floors: list | None = None):
    """(number of the query, id, score) of the k best vectors of every query; ``own`` are ids that do not count.

    Vectors that score less than a query's number in ``floors``, if it has one, may be left out.
    """
    kind = _exact(queries, vectors)
    postings = np.ascontiguousarray(_cast(vectors, kind).T)
    queries = _cast(queries, kind)
    low, high = postings.min(axis=1), postings.max(axis=1)
    scratch = np.empty(len(ids), kind)
    found = []
    for number, query in enumerate(queries):
        bound, offset = np.maximum(query * low, query * high), np.minimum(query * low, query * high)
        order = np.argsort(-(bound - offset).astype(np.float64), kind="stable")
        rest = np.cumsum(bound[order][::-1])[::-1]  # bound of this and all later terms
        rest = np.append(rest, rest.dtype.type(0) if kind is not object else 0)
        open_ = ids != own[number]
        # a first threshold from the vectors that are best by the strongest terms
        head = order[: max(1, len(order) // 8)]
        score = np.zeros(len(ids), kind)
        for term in head:
            np.multiply(postings[term], query[term], out=scratch)
            score += scratch
        some = np.flatnonzero(open_)
        if len(some) > 8 * k:
            some = some[np.argsort(-score[some].astype(np.float64), kind="stable")[: 8 * k]]
        threshold = _kth(query @ postings[:, some], k)
        if floors and floors[number] is not None and (threshold is None or floors[number] > threshold):
            threshold = floors[number]
        # essential terms: without them the offsets and all later bounds fall short of the threshold
        essential = len(order)
        if threshold is not None:
            without = np.cumsum(offset[order])
            for n in range(len(head), len(order)):
                if without[n - 1] + rest[n] < threshold:
                    essential = n
                    break
        for term in order[len(head) : essential]:
            np.multiply(postings[term], query[term], out=scratch)
            score += scratch
        alive = np.flatnonzero(open_ & (score + rest[essential] >= threshold)) if threshold is not None else np.flatnonzero(open_)
        score = score[alive]
        for n in range(essential, len(order)):
            score = score + query[order[n]] * postings[order[n], alive]
            if threshold is not None and (n - essential) % _PRUNE == _PRUNE - 1:
                keep = score + rest[n + 1] >= threshold
                alive, score = alive[keep], score[keep]
        exact = [int(s) for s in score] if kind is object else score.astype(np.int64).tolist()
        best = sorted(zip(exact, ids[alive].tolist()), key=lambda p: (-p[0], p[1]))[:k]
        found += [(number, name, min(max(s, _LOW), _HIGH)) for s, name in best]
    return found


def top_k(
    queries: DataFrame, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = TOP, scale: float | None = None,
    block: int | None = None, shard: int = SHARD,
) -> DataFrame:
    """Each query's ``k`` best rows of ``vectors``: ``query_id``, ``rank`` from 1, the id and ``score``.

    With ``scale`` every component is multiplied by it and rounded down first; without, components must be whole numbers.
    A block has ``block`` queries, as many as fit into ``BLOCK_BYTES`` by default.
    """
    parts = []
    for frame in (queries, vectors):
        vector = F.col(vector_col).cast("array<double>")
        held = frame.where(F.col(id_col).isNotNull() & valid(vector)).select(F.col(id_col).cast("long").alias("id"), vector.alias("v"))
        parts.append(held)
    asked, stored = parts
    size = lambda frame: frame.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    (n_asked, width), (n_stored, _) = size(asked), size(stored)
    n_shards = max(1, -(-n_stored // shard))
    n_blocks = max(1, -(-n_asked // (block or max(1, BLOCK_BYTES // (8 * max(width, 1))))))
    asked = written(asked.withColumn("q", F.monotonically_increasing_id()), "queries")
    asked = asked.withColumn("b", F.pmod(F.xxhash64(F.lit(1), "q"), F.lit(n_blocks)).cast("int"))
    stored = stored.withColumn("s", F.pmod(F.xxhash64(F.lit(2), "id", "v"), F.lit(n_shards)).cast("int"))
    kind = "q long, query_id long, vec_id long, score long"

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["q", "query_id", "vec_id", "score"]
        if not len(left) or not len(right):
            return pd.DataFrame(columns=columns).astype("int64")
        width = max(left["v"].map(len).max(), right["v"].map(len).max(), 1)
        sides = [_matrix(side["v"].to_numpy(), width) for side in (left, right)]
        if scale is not None:
            sides = [np.floor(side * scale) for side in sides]
        own = left["id"].to_numpy()
        floors = [None if pd.isna(f) else int(f) for f in left["floor"]]
        hits = search_shard(sides[0], own, sides[1], right["id"].to_numpy(), k, floors)
        number = left["q"].to_numpy()
        return pd.DataFrame([(number[n], own[n], name, score) for n, name, score in hits], columns=columns).astype("int64")

    def met(asked: DataFrame, stored: DataFrame, shards: range) -> DataFrame:
        asked = asked.withColumn("s", F.explode(F.array(*[F.lit(s) for s in shards]) if len(shards) == 1 else F.sequence(F.lit(shards[0]), F.lit(shards[-1]))))
        stored = stored.where(F.col("s").between(shards[0], shards[-1])).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
        return asked.groupBy("b", "s").cogroup(stored.groupBy("b", "s")).applyInPandas(search, kind)

    none = F.lit(None).cast("string")
    best = met(asked.withColumn("floor", none), stored, range(1))
    if n_shards > 1:
        best = written(best, "first-shard")
        # the k-th score, as text: a long with nulls would become a float in pandas
        floors = best.groupBy("q").agg(F.when((F.count(F.lit(1)) >= k) & (F.min("score") > _LOW), F.min("score")).cast("string").alias("floor"))
        best = best.unionByName(met(asked.join(floors, "q", "left"), stored, range(1, n_shards)))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec_id").alias(id_col), "score")
