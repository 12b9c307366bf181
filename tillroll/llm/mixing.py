"""Mixing overlapping sources to target weights, as a flow of least cost.

Documents are aggregated by the set of sources they belong to. The size of such a pattern is its capacity, once per
repetition, and every further repetition costs one more per word than the one before. The flow of largest volume and
least cost from patterns to source quotas says how much of each pattern every source takes. It is solved on the
driver, over one node per pattern and per source: metadata that grows with the number of sources, not with the rows.
Documents are then laid end to end on a line per pattern, in a seeded order, once per repetition; each source's share
is a stretch of that line, and a copy of a document belongs to the stretch that holds its middle.

A null text has size 0, a null source is a source of its own and comes last; a document of size 0 is never taken. Rows
are mixed one by one, so repeated rows and ids count separately. The seeded order is that of a digest of the whole row,
so that rows with one id, or none, are spread as well and their order does not hang on the partitioning; rows that are
equal throughout are interchangeable. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.llm.expressions import hashable
from tillroll.staging import written

REPEATS = 3
SEED = 17
SLICES = 4096
_ROOT, _SINK = ("root",), ("sink",)


def n_words(text: Column | str) -> Column:
    """Runs of anything but ASCII white space."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: dict, repeats: int = REPEATS) -> dict:
    """The quota of each source: weights 1, 2, 3, repeating in code point order, null last, of the sum of all sizes.

    A source gets at most ``repeats`` times its size; what is over is shared by weight among the others.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + n % 3 for n, s in enumerate(order)}
    quota: dict = {}
    free, left = order, float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > repeats * sizes[s]]
        if not over:
            quota |= {s: left * weight[s] / total for s in free}
            break
        quota |= {s: float(repeats * sizes[s]) for s in over}
        left -= sum(quota[s] for s in over)
        free = [s for s in free if s not in quota]
    return quota


def least_cost_flow(capacity: dict[tuple, int], quota: dict, repeats: int = REPEATS) -> dict[tuple, dict]:
    """For each pattern (a tuple of sources) what every source takes of it, in words.

    Successive shortest paths with node potentials. The arc into a pattern is convex: its cost is the number of
    repetitions it already carries in full.
    """
    used = dict.fromkeys(capacity, 0)
    taken: dict[tuple, dict] = {p: defaultdict(int) for p in capacity}
    got = dict.fromkeys(quota, 0)
    of_source = defaultdict(list)
    for pattern in capacity:
        for source in pattern:
            of_source[source].append(pattern)
    potential = dict.fromkeys([_ROOT, _SINK, *(("p", p) for p in capacity), *(("s", s) for s in quota)], 0)

    def arcs(node):
        """(next node, cost, room) in the residual network."""
        if node is _ROOT:
            for p, size in capacity.items():
                if used[p] < repeats * size:
                    yield ("p", p), used[p] // size, size - used[p] % size
        elif node[0] == "p":
            p = node[1]
            for s in p:
                yield ("s", s), 0, 1 << 62
            if used[p]:
                back = (used[p] - 1) // capacity[p]
                yield _ROOT, -back, used[p] - back * capacity[p]
        elif node[0] == "s":
            s = node[1]
            if got[s] < quota[s]:
                yield _SINK, 0, quota[s] - got[s]
            for p in of_source[s]:
                if taken[p][s]:
                    yield ("p", p), 0, taken[p][s]

    while True:
        best, before, done = {_ROOT: 0}, {}, set()
        heap, ticket = [(0, 0, _ROOT)], 0
        while heap:
            cost, _, node = heapq.heappop(heap)
            if node in done:
                continue
            done.add(node)
            for other, price, room in arcs(node):
                total = cost + price + potential[node] - potential[other]
                if other not in best or total < best[other]:
                    best[other], before[other] = total, (node, room)
                    ticket += 1
                    heapq.heappush(heap, (total, ticket, other))
        if _SINK not in before:
            return {p: {s: w for s, w in shares.items() if w} for p, shares in taken.items()}
        far = best[_SINK]
        for node in potential:
            potential[node] += min(best.get(node, far), far)
        path, node = [], _SINK
        while node is not _ROOT:
            path.append((before[node][0], node))
            node = before[node][0]
        amount = min(before[node][1] for _, node in path)
        for a, b in path:
            if a is _ROOT:
                used[b[1]] += amount
            elif b is _ROOT:
                used[a[1]] -= amount
            elif a[0] == "p":
                taken[a[1]][b[1]] += amount
            elif b is _SINK:
                got[a[1]] += amount
            else:
                taken[b[1]][a[1]] -= amount


def mix(docs: DataFrame, size: Column, sources: Column, key: Column, repeats: int = REPEATS, seed: int = SEED, slices: int = SLICES) -> DataFrame:
    """``docs`` with ``mix_size``, ``mix_sources`` and ``mix_copies``: one struct (repetition, source) per copy that is taken.

    ``size`` counts words, ``sources`` is an array of the sources a row belongs to, ``key`` names a row; rows of one key
    are told apart by all their columns. Columns of these names are replaced. Within a pattern and repetition the order is that of a seeded hash; it is
    cut into ``slices`` by the hash, so that no window holds more than a slice of a source.
    """
    return _lined(docs, size, sources, key, repeats, seed, slices).select(
        *[F.col("doc")[c].alias(c) for c in docs.columns if c not in ("mix_size", "mix_sources", "mix_copies")],
        *[F.col(c).alias(f"mix_{c}") for c in ("size", "sources", "copies")],
    )


def _lined(docs: DataFrame, size: Column, sources: Column, key: Column, repeats: int, seed: int, slices: int) -> DataFrame:
    """(doc, size, sources, copies) by row; ``doc`` is the row as it was."""
    pattern = F.array_sort(F.array_distinct(sources))
    rows = docs.select(
        F.struct("*").alias("doc"),
        size.alias("size"),
        pattern.alias("sources"),
        F.xxhash64(key).alias("key"),
        F.xxhash64(F.lit(seed), key, *hashable(docs)).alias("place"),
    )
    rows = written(rows.withColumn("slice", F.pmod(F.shiftright("place", 20), F.lit(slices))), "mix-rows")
    in_slices = written(rows.groupBy("sources", "slice").agg(F.sum("size").alias("words")), "mix-slices")
    laps = in_slices.groupBy("sources").agg(F.sum("words").alias("lap"))
    held = {tuple(r.sources): r.lap for r in laps.collect()}  # one row per pattern
    sizes: dict = defaultdict(int)
    for pattern, words in held.items():
        for member in pattern:
            sizes[member] += words  # a source without words has its place among the weights as well
    capacity = {p: words for p, words in held.items() if words}
    # overlapping sources hold more together than all documents; the quotas share what there is
    share = sum(capacity.values()) / sum(sizes.values()) if capacity else 0
    quota = {s: int(q * share) for s, q in targets(sizes, repeats).items()}
    flow = least_cost_flow(capacity, quota, repeats)

    kind = rows.schema["sources"].dataType.elementType.simpleString()
    stretches = [(list(p), *stretch) for p, shares in flow.items() for stretch in _stretches(shares)]
    plan = docs.sparkSession.createDataFrame(stretches, f"sources array<{kind}>, source {kind}, low long, high long")
    plan = plan.groupBy("sources").agg(F.collect_list(F.struct("source", "low", "high")).alias("plan"))
    plan = plan.join(laps, "sources")  # one row per pattern, like the flow

    before = Window.partitionBy("sources").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = in_slices.select("sources", "slice", F.sum("words").over(before).alias("start"))
    inside = Window.partitionBy("sources", "slice").orderBy("place", "key").rowsBetween(Window.unboundedPreceding, -1)
    lined = rows.withColumn("inside", F.sum("size").over(inside)).join(starts, ["sources", "slice"])
    lined = lined.join(F.broadcast(plan), "sources", "left")
    at = F.coalesce("start", F.lit(0)) + F.coalesce("inside", F.lit(0))

    def copies_of(lap):
        middle = 2 * (at + lap * F.col("lap")) + F.col("size")
        here = F.filter("plan", lambda s: (2 * s["low"] < middle) & (middle <= 2 * s["high"]))
        return F.transform(here, lambda s: F.struct(lap.cast("int").alias("repetition"), s["source"].alias("source")))

    copies = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), copies_of))
    none = F.array().cast(f"array<struct<repetition:int,source:{kind}>>")
    copies = F.when((F.col("size") > 0) & F.col("plan").isNotNull(), copies).otherwise(none)
    return lined.select("doc", "size", "sources", copies.alias("copies"))


def _stretches(shares: dict) -> list[tuple]:
    out, at = [], 0
    for source in sorted(shares, key=lambda s: (s is None, s or "")):
        out.append((source, at, at + shares[source]))
        at += shares[source]
    return out


def mixed_documents(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken. Columns are those of ``docs``, whatever their names."""
    settings = {"repeats": REPEATS, "seed": SEED, "slices": SLICES} | options
    rows = _lined(docs, n_words(text_col), F.array(F.col(source_col)), F.col(id_col), **settings)
    return rows.select("doc", F.explode("copies").alias("copy")).select("doc.*")
