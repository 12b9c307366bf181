"""Self-join of documents whose sets of word shingles have a Jaccard similarity of at least a threshold.

Documents with equal sets are copies and are joined as one. A set is represented by ``POSITIONS`` shingles, each the
smallest under a hash of its own, so that two sets agree at a position as often as they are similar. The join follows
chosen paths: in every run a node of the recursion draws positions, ``1 / threshold`` of them on average, and splits
its sets by the shingle they have there. Buckets of one are dropped, buckets of at most ``limit`` are compared by brute
force, larger ones are split again, each with draws of its own. Pairs that are similar enough meet in every step of a
path more often than once, others die out. Large buckets whose sets are like one of theirs would split forever; they are
compared by brute force as well. A single path misses a pair now and then, and the more often the deeper it goes: a pair
that is only just similar and is compared ``d`` splits deep meets in one run with probability 0.64, 0.47, 0.38, 0.32,
0.27 for d = 1 to 5, and 0.13 for d = 13. Hence all sets go through ``runs`` runs, and those whose buckets were split so often
that this is too little for ``recall`` through as many more as their depth needs, until no set lies deeper than its runs allow.
Both sets of a pair go as deep as the pair, so both take part in the runs that it needs.

A bucket is compared where its sets fit into memory together: those of up to ``block`` sets and ``BYTES`` of shingles are
one group of rows, in which every set has one row. Only a bucket beyond that is cut into blocks, which meet two by two, so
that no bucket lands in one task; a set of it then has a row for each block. Pairs exist inside tasks only, never as rows.
Pairs that agree at enough positions are kept by the first of the buckets that both sets share, and only there, so
that every link is counted once without a table of pairs. The shingles of the sets that are left are made from
the texts once more and the similarity is counted exactly.

A null text is an empty one. Texts without words are copies of each other and of nothing else. Rows are joined one by
one, so ids may repeat or be null; the class id is the smallest id of the class, null if it has none. Only the id and
text are read, so extra columns cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.components import components
from tillroll.llm.expressions import hashable
from tillroll.llm.shingles import WIDTH, chunks, mixed, numbers, shingle_sets
from tillroll.staging import written

THRESHOLD = 0.8
RUNS = 10
#: Least probability to meet of a pair whose similarity is the threshold.
RECALL = 0.95
POSITIONS = 64
LIMIT = 256
BLOCK = 1024
BYTES = 8 << 20
SALTS = 32
DEPTH = 12
MOST_RUNS = 4096
#: Pairs whose share of equal positions is so far below the threshold are not verified: 4 standard deviations.
MARGIN = 0.2
_SET = "struct<n:int,d1:long,d2:long,sketch:array<int>>"


def signature(text: Column, width: int, positions: int) -> Column:
    """The size, digest and sampled shingles of a text's set."""

    @F.pandas_udf(_SET)
    def sign(texts: pd.Series) -> pd.DataFrame:
        texts = list(texts)
        times, plus = numbers(11, positions), numbers(12, positions)
        sizes, one, two, sketches = [], [], [], []
        for low, high in chunks(texts):
            tokens, bounds = shingle_sets(texts[low:high], width)
            size = np.diff(bounds)
            some = np.flatnonzero(size)
            first, second = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
            sketch = np.zeros((len(size), positions), np.uint32)
            if len(some):
                cuts = bounds[some]
                first[some] = np.add.reduceat(mixed(tokens + np.uint64(3)), cuts)
                second[some] = np.add.reduceat(mixed(tokens + np.uint64(7)), cuts)
                for j in range(positions):
                    sketch[some, j] = np.minimum.reduceat(tokens * times[j] + plus[j], cuts) >> np.uint64(32)
            sizes.append(size)
            one.append(first.view(np.int64))
            two.append(second.view(np.int64))
            sketches += list(sketch.view(np.int32))
        if not texts:
            return pd.DataFrame({"n": [], "d1": [], "d2": [], "sketch": []})
        return pd.DataFrame({"n": np.concatenate(sizes), "d1": np.concatenate(one), "d2": np.concatenate(two), "sketch": sketches})

    return sign(text)


def _whole_groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[list[pd.DataFrame]]:
    """The groups of a partition that is sorted by ``keys``, some at a time; a group never spans two lists."""
    rest = None
    for frame in frames:
        if not len(frame):
            continue
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        columns = [frame[k].to_numpy() for k in keys]
        new = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
        bounds = [0, *new.tolist(), len(frame)]
        if len(bounds) > 2:
            yield [frame.iloc[a:b] for a, b in zip(bounds[:-2], bounds[1:-1])]
        rest = frame.iloc[bounds[-2] :]
    if rest is not None:
        yield [rest]


def _plausible(sketch: np.ndarray, n: np.ndarray, side: np.ndarray, low: float, threshold: float):
    """(a, b, fit): which of the sets ``a`` and ``b`` of a group can be similar; ``side`` is 0 or 1 if two blocks meet, else 0."""
    a = np.flatnonzero(side == 0)
    b = np.flatnonzero(side == 1) if side.any() else a
    same = np.zeros((len(a), len(b)), np.int16)
    for j in range(sketch.shape[1]):
        same += sketch[a, j][:, None] == sketch[b, j][None, :]
    fit = same >= low * sketch.shape[1]
    fit &= np.minimum(n[a][:, None], n[b][None, :]) >= threshold * np.maximum(n[a][:, None], n[b][None, :])
    return a, b, fit if side.any() else np.triu(fit, 1)


def _met_before(buckets: list[np.ndarray], key: int, a: np.ndarray, b: np.ndarray, fit: np.ndarray) -> np.ndarray:
    """``fit`` without the pairs that share a bucket before ``key``; they are kept there."""
    earlier = [np.unique(k[k < key]) for k in buckets]
    flat, owner = np.concatenate(earlier), np.repeat(np.arange(len(earlier)), [len(k) for k in earlier])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    place_a, place_b = np.full(len(buckets), -1), np.full(len(buckets), -1)
    place_a[a], place_b[b] = np.arange(len(a)), np.arange(len(b))
    for members in np.split(owner, np.flatnonzero(np.diff(flat)) + 1):
        if len(members) > 1:
            one, two = place_a[members], place_b[members]
            fit[np.ix_(one[one >= 0], two[two >= 0])] = False
    return fit


def _candidates(threshold: float):
    """Rows of a pair of blocks with the partners that are kept for verification."""
    keys = ["key", "i", "j"]

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for groups in _whole_groups(frames, keys):
            out = []
            for group in groups:
                if len(group) < 2:
                    continue
                key = int(group["key"].iat[0])
                names = group["set"].to_numpy()
                sketch = np.stack(group["sketch"].to_numpy())
                a, b, fit = _plausible(sketch, group["n"].to_numpy(), group["side"].to_numpy(), threshold - MARGIN, threshold)
                if fit.any():
                    fit = _met_before(group["buckets"].tolist(), key, a, b, fit)
                found = dict.fromkeys(b[fit.any(axis=0)].tolist(), names[:0])
                found |= {int(a[x]): names[b[np.flatnonzero(fit[x])]] for x in np.flatnonzero(fit.any(axis=1))}
                out += [(key, int(group["i"].iat[0]), int(group["j"].iat[0]), int(names[p]), partners) for p, partners in found.items()]
            yield pd.DataFrame(out, columns=[*keys, "set", "partners"])

    return find


def shared_counts(left: list[np.ndarray], right: list[np.ndarray], width: int = 512) -> np.ndarray:
    """How many elements each left set shares with each right set; sets have fewer than 2**24, so the sums are exact."""
    values, number = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    order = np.argsort(number, kind="stable")
    number, row = number[order], row[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, len(values), width):
        here = slice(*np.searchsorted(number, [low, low + width]))
        table = np.zeros((len(left) + len(right), width), np.float32)
        table[row[here], number[here] - low] = 1
        out += table[: len(left)] @ table[len(left) :].T
    return out


def _roots(count: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """By node, the smallest node it hangs together with over the edges (p, q)."""
    root = np.arange(count)
    while True:
        low = root.copy()
        np.minimum.at(low, p, root[q])
        np.minimum.at(low, q, root[p])
        low = low[low]
        if np.array_equal(low, root):
            return root
        root = low


def _verified(threshold: float):
    """Per pair of blocks: its sets with the copies they link to and the smallest set they hang together with."""

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for groups in _whole_groups(frames, ["key", "i", "j"]):
            out = []
            for group in groups:
                group = group.sort_values("set")
                names = group["set"].to_numpy()
                tokens = [np.frombuffer(t, np.uint64) for t in group["tokens"]]
                size, copies = np.array([len(t) for t in tokens]), group["copies"].to_numpy()
                p = np.repeat(np.arange(len(names)), [len(x) for x in group["partners"]])
                q = np.searchsorted(names, np.concatenate(group["partners"].to_numpy()))
                if len(p) > 2 * len(names) and size.max() < 1 << 24:
                    (a, at_a), (b, at_b) = np.unique(p, return_inverse=True), np.unique(q, return_inverse=True)
                    shared = shared_counts([tokens[x] for x in a], [tokens[x] for x in b])[at_a, at_b].astype(np.int64)
                else:
                    shared = np.array([len(np.intersect1d(tokens[x], tokens[y], assume_unique=True)) for x, y in zip(p, q)], np.int64)
                link = shared / (size[p] + size[q] - shared) >= threshold
                p, q = p[link], q[link]
                links, root = np.zeros(len(names), np.int64), names[_roots(len(names), p, q)]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                some = np.flatnonzero(links)
                out.append(pd.DataFrame({"set": names[some], "root": root[some], "links": links[some]}))
            yield pd.concat(out, ignore_index=True)

    return verify


def _tokens(text: Column, width: int) -> Column:
    @F.pandas_udf("binary")
    def pack(texts: pd.Series) -> pd.Series:
        texts, out = list(texts), []
        for low, high in chunks(texts):
            tokens, bounds = shingle_sets(texts[low:high], width)
            out += [tokens[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
        return pd.Series(out, dtype=object)

    return pack(text)


def meeting(depth: int, threshold: float, positions: int, runs: int) -> float:
    """How likely a pair at the threshold meets in one of ``runs`` runs, if it is compared after ``depth`` splits.

    The positions the pair agrees at are the same in every run; their number varies from pair to pair.
    """
    total = 0.0
    for agree in range(positions + 1):
        alive = 1.0
        for _ in range(depth):
            alive = 1 - (1 - alive / (threshold * positions)) ** agree
        total += math.comb(positions, agree) * threshold**agree * (1 - threshold) ** (positions - agree) * (1 - (1 - alive) ** runs)
    return total


def needed_runs(depth: int, threshold: float, positions: int, recall: float) -> int:
    """The least number of runs after which a pair at the threshold has met with probability ``recall``."""
    if not 0 < recall < 1:
        raise ValueError("recall must lie between 0 and 1")
    high = 1
    while meeting(depth, threshold, positions, high) < recall:
        high *= 2
        if high > MOST_RUNS:
            raise ValueError(f"a recall of {recall} needs more than {MOST_RUNS} runs")
    return next(n for n in range(high // 2, high + 1) if n and meeting(depth, threshold, positions, n) >= recall)


def _paths(sets: DataFrame, starts: DataFrame, threshold: float, positions: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """(key, set, size, weight) of the buckets that are to be compared, and (set, depth): how deep the buckets of a set lie.

    ``starts`` are (path, set, n, sketch) of the runs to make. A bucket's weight is the number of shingles of its sets.
    """
    draw = int(threshold * positions * 1_000_000)

    def split(nodes: DataFrame) -> DataFrame:
        """The children of ``nodes`` (path, set, n, sketch)."""
        drawn = F.filter(
            F.sequence(F.lit(0), F.lit(positions - 1)),
            lambda j: F.pmod(F.xxhash64("path", j), F.lit(draw)) < 1_000_000,
        )
        child = F.explode(F.transform(drawn, lambda j: F.xxhash64("path", j, F.get("sketch", j))))
        keyed = written(nodes.select(child.alias("key"), "set", "n"), "path-keys")
        # equal members give equal sums; of such buckets one is enough
        member = F.xxhash64("set")
        sizes = keyed.groupBy("key").agg(
            F.count("*").alias("size"),
            F.sum("n").alias("weight"),
            F.sum(member.cast("decimal(38,0)")).alias("members"),
            F.bit_xor(F.xxhash64("set", F.lit(1))).alias("parity"),
        ).where("size > 1")
        sizes = sizes.groupBy("size", "weight", "members", "parity").agg(F.min("key").alias("key"))
        return written(keyed.drop("n").join(sizes.select("key", "size", "weight"), "key"), "path-buckets")

    # a bucket may hold a third of all sets, so its sets are dealt by salts as well
    salt = F.pmod(F.xxhash64("set"), F.lit(SALTS)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")

    buckets = split(starts)
    found = buckets.where(F.col("size") <= limit)
    depths = found.select("set", F.lit(1).alias("depth"))
    for depth in range(1, DEPTH + 1):
        large = buckets.where(F.col("size") > limit)
        if large.isEmpty():
            return found, depths
        nodes = large.withColumnRenamed("key", "path").join(sets.select("set", "n", "sketch"), "set").withColumn("salt", salt)
        # how much the sets of a bucket are like one of them; buckets of similar sets would not come apart
        pivot = nodes.groupBy("path").agg(F.min_by("sketch", F.xxhash64("set", "path")).alias("pivot")).select("path", "pivot", salts)
        same = F.size(F.filter(F.zip_with("sketch", "pivot", lambda x, y: x == y), lambda e: e)) / positions
        near = nodes.join(pivot, ["path", "salt"]).groupBy("path").agg(F.avg(same).alias("near"))
        near = written(near.select("path", (F.col("near") >= threshold - MARGIN).alias("dense")), "path-density")
        nodes = written(nodes.join(near.select("path", "dense", salts), ["path", "salt"]).drop("salt"), "path-large")
        dense = nodes.where("dense").select(F.col("path").alias("key"), "set", "size", "weight")
        # a set that is split once more may be lost by that, and then lies in no bucket of the next depth
        depths = depths.unionByName(nodes.select("set", F.when(F.col("dense"), depth).otherwise(depth + 1).alias("depth")))
        buckets = split(nodes.where("NOT dense").select("path", "set", "n", "sketch"))
        found = found.unionByName(dense).unionByName(buckets.where(F.col("size") <= limit))
    # what has not come apart by now is compared as it is, in blocks
    return found.unionByName(buckets.where(F.col("size") > limit)), depths


def _leaves(sets: DataFrame, threshold: float, runs: int, positions: int, limit: int, recall: float) -> DataFrame:
    """(key, set, size, weight) of all buckets that are to be compared, of as many runs as the recall needs."""
    needs = [max(runs, needed_runs(max(d, 1), threshold, positions, recall)) for d in range(DEPTH + 2)]
    asked = F.get(F.array(*map(F.lit, needs)), F.col("depth"))
    root = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(runs).cast("long")))
    found, depths = _paths(sets, sets.select("set", "n", "sketch", root.alias("path")), threshold, positions, limit)
    if needs[1] > runs:  # then even sets without a bucket, and else only those that lie deep
        depths = depths.unionByName(sets.select("set", F.lit(1).alias("depth")))
    deepest = depths.where(asked > runs).groupBy("set").agg(F.max(asked).alias("needed"))
    state = written(deepest.select("set", F.lit(runs).alias("done"), "needed"), "path-runs")
    for again in itertools.count(1):  # the depth, and with it the number of runs, has a bound
        low = state.where("needed > done").agg(F.min("done")).first()[0]
        if low is None:
            return found
        # sets that lie deeper than before meet in new runs with those that were known to lie so deep
        run = F.explode(F.sequence(F.lit(low + 1).cast("long"), F.col("needed").cast("long")))
        starts = state.where(F.col("needed") > low).join(sets.select("set", "n", "sketch"), "set").select("set", "n", "sketch", run.alias("run"))
        starts = starts.select("set", "n", "sketch", F.xxhash64(F.lit(again), "run").alias("path"))
        more, depths = _paths(sets, starts, threshold, positions, limit)
        found = found.unionByName(more)
        deepest = depths.groupBy("set").agg(F.max(asked).alias("asked"))
        state = state.join(deepest, "set", "left").select("set", F.col("needed").alias("done"), F.greatest("needed", "asked").alias("needed"))
        state = written(state, "path-runs")


def _links(texts: DataFrame, sets: DataFrame, threshold: float, width: int, runs: int, limit: int, block: int, recall: float) -> DataFrame:
    """(set, root, links) of the sets that are similar to another, a row per place where they were compared."""
    leaves = written(_leaves(sets, threshold, runs, POSITIONS, limit, recall), "path-leaves")
    buckets = leaves.groupBy("set").agg(F.collect_list("key").alias("buckets"))
    facts = sets.select("set", "n", "sketch").join(buckets, "set")
    blocks = F.greatest(F.ceil(F.col("size") / block), F.ceil(F.col("weight") * 8 / BYTES)).cast("int")
    own = F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
    met = (
        leaves.withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "key",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
            "set",
        )
    )
    pairs = ["key", "i", "j"]
    held = met.join(facts, "set").repartition(*pairs).sortWithinPartitions(*pairs)
    kept = held.mapInPandas(_candidates(threshold), "key long, i int, j int, set long, partners array<long>")
    kept = written(kept, "path-candidates")

    wanted = kept.select("set").distinct().join(sets.select("set", "copies", *_KEY), "set")
    tokens = _at(texts, wanted, "inner").select("set", "copies", _tokens(F.col("text"), width).alias("tokens"))
    tokens = written(tokens, "path-tokens")
    checked = kept.join(tokens, "set").repartition(*pairs).sortWithinPartitions(*pairs)
    return written(checked.mapInPandas(_verified(threshold), "set long, root long, links long"), "path-links")


_KEY = ["ih", "th"]


def _keys(id_col: Column, text_col: Column) -> list[Column]:
    """Hashes of id and text, never null, that together tell rows apart unless both are equal."""
    return [F.xxhash64(id_col).alias("ih"), F.xxhash64(text_col).alias("th")]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *_keys(F.col(id_col), F.col(text_col)))


def _at(texts: DataFrame, wanted: DataFrame, how: str) -> DataFrame:
    """The rows of ``texts`` with a key of ``wanted``, one for each key.

    The texts are shuffled at any size: ``wanted`` grows with the input, and a plan that broadcasts it while it is small
    would say nothing about larger inputs.
    """
    return texts.join(wanted.hint("shuffle_hash"), _KEY, how).dropDuplicates(_KEY)


def _classes(texts: DataFrame, threshold: float, width: int, runs: int, limit: int, block: int, recall: float) -> DataFrame:
    """``texts`` as (row, id, ih, th, class_row, class_id, n_links)."""
    signed = texts.select(F.monotonically_increasing_id().alias("row"), "id", *_KEY, signature(F.col("text"), width, POSITIONS).alias("s"))
    signed = written(signed.select("row", "id", *_KEY, "s.*"), "signatures")
    same = ["n", "d1", "d2"]
    held = signed.groupBy(*same).agg(F.min("row").alias("set"), F.count("*").alias("copies"), F.min("id").alias("least"))
    held = written(held, "sets")
    first = signed.select(F.col("row").alias("set"), *_KEY, "sketch")
    sets = written(held.where("n > 0").join(first, "set").select("set", "n", "copies", *_KEY, "sketch"), "set-sketches")

    links = _links(texts, sets, threshold, width, runs, limit, block, recall)
    root = written(components(links.select(F.col("set").alias("a"), F.col("root").alias("b"))), "roots")
    total = links.groupBy("set").agg(F.sum("links").alias("links"))
    per_set = held.join(root.withColumnRenamed("node", "set"), "set", "left").join(total, "set", "left")
    per_set = per_set.withColumn("root", F.coalesce("root", "set"))
    least = per_set.groupBy("root").agg(F.min("least").alias("class_id"))
    per_set = per_set.join(least, "root").select(
        *same, F.col("root").alias("class_row"), "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    return signed.select("row", "id", *_KEY, *same).join(per_set, same).drop(*same)


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, width: int = WIDTH,
    runs: int = RUNS, limit: int = LIMIT, block: int = BLOCK, recall: float = RECALL,
) -> DataFrame:
    """One row per document: the id, ``class_id`` and ``n_links``, the number of other documents it is similar to.

    A class holds the documents that links connect. ``runs`` are made for all sets; more follow where ``recall`` needs them.
    """
    classes = _classes(_texts(docs, id_col, text_col), threshold, width, runs, limit, block, recall)
    return classes.select(F.col("id").alias(id_col), "class_id", "n_links")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class: that with the smallest id, nulls last.

    Of rows with that id, the one with the smallest digest of the text stays, and of these that with the smallest digest of
    the whole row; rows that are equal throughout are the same.
    """
    settings = {"threshold": THRESHOLD, "width": WIDTH, "runs": RUNS, "limit": LIMIT, "block": BLOCK, "recall": RECALL} | options
    classes = written(_classes(_texts(docs, id_col, text_col), **settings), "classes")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", *_KEY))
    keep = classes.groupBy("class_row").agg(first.alias("f")).select("f.ih", "f.th").distinct()
    whole = docs.select(F.struct("*").alias("doc"), *_keys(F.col(id_col), F.col(text_col)))
    held = whole.join(keep.hint("shuffle_hash"), _KEY, "left_semi")
    return held.withColumn("row", F.xxhash64(*hashable(docs, "doc"))).groupBy(*_KEY).agg(F.min_by("doc", "row").alias("doc")).select("doc.*")
