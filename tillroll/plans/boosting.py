"""Boosted regression trees over binned features, with second-order gains, grown leaf by leaf or level by level.

The features are cut into bins once, at their quantiles, and the binned rows are written. Growing is rounds of one job:
every task adds up gradients and row counts by (fit, node, feature, bin) for the rows it has, the sums of all tasks
meet per node, and the best split of each node comes back: a few numbers, whatever the rows. A job serves every open node of
every fit, so many fits (the settings and folds of a search) cost the jobs of the largest one. Leaf by leaf, the node of
largest gain is split next until there are ``leaves``; nodes that may be next are looked at ahead of time, so that a tree
takes about as many jobs as it is deep.

A split's gain is ``(GL^2 / (HL + lam) + GR^2 / (HR + lam) - G^2 / (H + lam)) / 2 - gamma``, with gradients G and second
derivatives H, for squared error the rows; a leaf's value is ``-rate * G / (H + lam)``. Gradients are rounded to
whole multiples of a unit so small that no sum of them exceeds 2**52: sums are exact and do not depend on their order.
Ties go to the first feature and the lowest bin. Rows and features of a tree are drawn by hashes of row, tree and seed.

Every ``STRIDE`` trees the scores so far are written to the shared folder, so a job applies few trees and no lineage grows.

Rows that fit in a task (``HELD``) need no rounds: a task per fit grows the same trees, to the last bit, from all of them.
"""

from __future__ import annotations

import heapq
import json
import random
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from tillroll.shipping import ship
from tillroll.staging import written

STRIDE = 10
PART = 4  # features whose sums of a node meet in one group
TASK_BYTES = 32 << 20  # of binned rows and scores
HELD = 16 << 20  # bins of the rows of a task
_DRAWS = 1 << 20


@dataclass(frozen=True)
class Growth:
    """The settings of one fit. ``leaves`` 0: level by level to ``depth``; ``depth`` 0: no limit."""

    rounds: int = 100
    rate: float = 0.1
    first: float = 0.0  # rate of the first tree; 0: as the others
    leaves: int = 31
    depth: int = 0
    lam: float = 0.0
    gamma: float = 0.0
    child_weight: float = 1e-3  # least sum of second derivatives of a child
    child_rows: int = 20
    row_share: float = 1.0
    column_share: float = 1.0
    seed: int = 42


@dataclass
class Split:
    gain: float
    feature: int
    bin: int
    left: tuple[float, int]  # gradient and rows
    right: tuple[float, int]


@dataclass
class Tree:
    """Nodes by number, the root first. ``children`` is 0 at leaves, else the left child's number; the right one follows."""

    feature: list[int] = field(default_factory=lambda: [0])
    bin: list[int] = field(default_factory=lambda: [0])
    children: list[int] = field(default_factory=lambda: [0])
    depth: list[int] = field(default_factory=lambda: [0])
    total: list[tuple[float, int]] = field(default_factory=lambda: [(0.0, 0)])
    best: list[Split | None] = field(default_factory=lambda: [None])
    known: list[bool] = field(default_factory=lambda: [False])
    value: list[float] = field(default_factory=list)

    def split(self, node: int, at: Split) -> None:
        self.feature[node], self.bin[node], self.children[node] = at.feature, at.bin, len(self.feature)
        for total in (at.left, at.right):
            self.feature.append(0)
            self.bin.append(0)
            self.children.append(0)
            self.depth.append(self.depth[node] + 1)
            self.total.append(total)
            self.best.append(None)
            self.known.append(False)


def _routed(tree: tuple[np.ndarray, np.ndarray, np.ndarray], bins: np.ndarray) -> np.ndarray:
    """The leaf of every row."""
    feature, cut, children = tree
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    while True:
        inner = children[node] > 0
        if not inner.any():
            return node
        at = node[inner]
        node[inner] = children[at] + (bins[rows[inner], feature[at]] > cut[at])


def _shape(tree: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.array(tree.feature), np.array(tree.bin), np.array(tree.children)


def _drawn(key: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    """Which rows take part in a tree."""
    x = key.view(np.uint64) ^ np.uint64((seed * 1_000_003 + tree * 7_919 + 1) & 0xFFFFFFFFFFFFFFFF)
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(times)
    return (x >> np.uint64(31)) % np.uint64(_DRAWS) < np.uint64(round(share * _DRAWS))


def best_split(sums: np.ndarray, rows: np.ndarray, g: Growth, features: list[int]) -> Split | None:
    """The split of largest gain of a node, given gradients and row counts by (feature, bin); None if none has a gain."""
    total, n = sums[0].sum(), rows[0].sum()
    left, n_left = np.cumsum(sums, axis=1)[:, :-1], np.cumsum(rows, axis=1)[:, :-1]
    right, n_right = total - left, n - n_left
    least = max(g.child_rows, g.child_weight, 1)
    fit = (n_left >= least) & (n_right >= least)
    if not fit.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left**2 / (n_left + g.lam) + right**2 / (n_right + g.lam) - total**2 / (n + g.lam)) / 2 - g.gamma
    gain = np.where(fit, gain, -np.inf)
    at = int(np.argmax(gain))
    f, b = divmod(at, gain.shape[1])
    # a gain within the rounding of its own terms is none
    if not gain[f, b] > 1e-12 * max(total**2 / max(n, 1), float((np.abs(left[f, b]) ** 2) / n_left[f, b])):
        return None
    return Split(float(gain[f, b]), features[f], b, (float(left[f, b]), int(n_left[f, b])), (float(right[f, b]), int(n_right[f, b])))


def _ahead(tree: Tree, g: Growth) -> tuple[list[int], bool]:
    """Chosen splits in order, and whether the tree is done. Gives nodes children that may have to be looked at next."""
    if not tree.known[0]:
        return [], False
    if not g.leaves:
        done = True
        for node in range(len(tree.feature)):
            if tree.known[node] and tree.best[node] and not tree.children[node]:
                tree.split(node, tree.best[node])
        done = all(tree.known)
        return [n for n in range(len(tree.feature)) if tree.children[n]], done
    heap = [(-tree.best[0].gain, 0)] if tree.best[0] else []
    chosen: list[int] = []
    while heap and len(chosen) < g.leaves - 1:
        node = heap[0][1]
        child = tree.children[node]
        last = len(chosen) == g.leaves - 2
        if not last and (not child or not (tree.known[child] and tree.known[child + 1])):
            room = g.leaves - 1 - len(chosen)
            for _, other in heapq.nsmallest(room, heap):
                if not tree.children[other]:
                    tree.split(other, tree.best[other])
            return chosen, False
        heapq.heappop(heap)
        chosen.append(node)
        if not child:
            tree.split(node, tree.best[node])
            child = tree.children[node]
        for c in (child, child + 1):
            if tree.known[c] and tree.best[c]:
                heapq.heappush(heap, (-tree.best[c].gain, c))
    return chosen, True


def _pruned(tree: Tree, chosen: list[int], g: Growth, unit: float, rate: float) -> Tree:
    """The tree with the chosen splits only, numbered anew, and the values of its leaves."""
    kept, out = set(chosen), Tree()
    out.total[0] = tree.total[0]
    places = {0: 0}
    for node in range(len(tree.feature)):  # children have larger numbers than their parents
        if node in kept and node in places:
            at = tree.best[node]
            out.split(places[node], at)
            child = out.children[places[node]]
            places[tree.children[node]], places[tree.children[node] + 1] = child, child + 1
    out.value = [0.0 if c or not n + g.lam else -rate * unit * total / (n + g.lam) for c, (total, n) in zip(out.children, out.total)]
    return out


@dataclass
class _Fit:
    growth: Growth
    fold: int  # rows of this fold are held out
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    tree: Tree | None = None
    columns: list[int] = field(default_factory=list)

    @property
    def open(self) -> bool:
        return len(self.trees) < self.growth.rounds


def bin_edges(rows: DataFrame, features: str, width: int, bins: int) -> list[list[float]]:
    """By feature, the values up to which a row lies in a bin; rows above the last are in a bin of their own."""
    shares = F.array(*[F.lit((k + 1) / bins) for k in range(bins - 1)])
    got = rows.agg(*[F.percentile_approx(F.col(features)[j], shares, 100 * bins).alias(f"q{j}") for j in range(width)]).first()
    return [sorted({float(v) for v in got[f"q{j}"] or []}) for j in range(width)]


def _binned(values: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    return np.stack([np.searchsorted(e, values[:, j], "left") for j, e in enumerate(edges)], axis=1) if len(values) else np.zeros((0, len(edges)), np.int64)


def _floats(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _bytes(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def _packed(matrix: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in matrix], pa.binary())


_STATE = "key long, fold int, y double, bins binary, scores binary"


def _scores_after(state: DataFrame, fits: list[_Fit], since: list[int], width: int) -> DataFrame:
    """``state`` with the trees from ``since`` on added to its scores."""
    new = [[(_shape(t), np.array(t.value)) for t in f.trees[s:]] for f, s in zip(fits, since)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, scores = _bytes(batch.column(3), np.uint16, width), _bytes(batch.column(4), np.float64, len(new)).copy()
            for k, trees in enumerate(new):
                for shape, value in trees:
                    scores[:, k] += value[_routed(shape, bins)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], _packed(scores)], names=batch.schema.names)

    return written(state.mapInArrow(add, _STATE), "boosting")


def _splits(state: DataFrame, fits: list[_Fit], since: list[int], width: int, n_bins: int, unit: float) -> list[tuple[int, int, int, float, Split | None]]:
    """(fit, node, rows, gradient, best split) of all nodes that are not known yet: one job."""
    work = []
    for k, (fit, first) in enumerate(zip(fits, since)):
        if fit.tree is not None and (nodes := [n for n, known in enumerate(fit.tree.known) if not known]):
            done = [(_shape(t), np.array(t.value)) for t in fit.trees[first:]]
            work.append((k, fit.fold, fit.growth, len(fit.trees), done, _shape(fit.tree), nodes, fit.columns))
    count = len(fits)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            key, fold, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            bins, scores = _bytes(batch.column(3), np.uint16, width), _bytes(batch.column(4), np.float64, count)
            for k, out, g, number, done, shape, nodes, columns in work:
                in_fit = fold != out
                if g.row_share < 1:
                    in_fit &= _drawn(key, number, g.seed, g.row_share)
                some = np.flatnonzero(in_fit)
                here = bins[some]
                score = scores[some, k].copy()
                for one, value in done:
                    score += value[_routed(one, here)]
                gradient = np.round((score - y[some]) / unit)
                leaf = _routed(shape, here)
                place = np.full(len(shape[0]), -1)
                place[nodes] = np.arange(len(nodes))
                seat = place[leaf]
                within = np.flatnonzero(seat >= 0)
                seat, gradient, here = seat[within], gradient[within], here[within]
                size = len(nodes) * n_bins
                for column in columns:
                    at = seat * n_bins + here[:, column]
                    sums = np.stack([np.bincount(at, gradient, size), np.bincount(at, minlength=size)]).reshape(2, len(nodes), n_bins)
                    old = held.get((k, column))
                    held[k, column] = sums if old is None else old + sums
        rows: dict[str, list] = {"fit": [], "node": [], "part": [], "sums": []}
        for k, _, _, _, _, _, nodes, columns in work:
            for low in range(0, len(columns), PART):
                if (k, columns[low]) not in held:
                    continue
                each = np.stack([held[k, c] for c in columns[low : low + PART]], axis=2)  # kind, node, feature, bin
                for n, node in enumerate(nodes):
                    if each[1, n].any():
                        rows["fit"].append(k)
                        rows["node"].append(node)
                        rows["part"].append(low)
                        rows["sums"].append(each[:, n].tobytes())
        yield pa.RecordBatch.from_pydict(rows, pa.schema([("fit", pa.int32()), ("node", pa.int32()), ("part", pa.int32()), ("sums", pa.binary())]))

    settings = {k: (g, columns) for k, _, g, _, _, _, _, columns in work}

    def choose(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        g, columns = settings[key[0]]
        features = columns[key[2] : key[2] + PART]
        sums = np.zeros(2 * len(features) * n_bins)
        for one in frame["sums"]:
            sums += np.frombuffer(one, np.float64)
        gradient, rows = sums.reshape(2, len(features), n_bins)
        unit_growth = replace(g, gamma=g.gamma / unit / unit)  # sums are in units
        best = best_split(gradient, rows, unit_growth, features)
        row = [*key[:2], int(rows[0].sum()), float(gradient[0].sum())]
        row += [best.gain, best.feature, best.bin, *best.left, *best.right] if best else [0.0, -1, 0, 0.0, 0, 0.0, 0]
        return pd.DataFrame([row], columns=_BEST)

    out = "fit int, node int, n long, g double, gain double, feature int, bin int, gl double, nl long, gr double, nr long"
    parts = state.mapInArrow(add, "fit int, node int, part int, sums binary").groupBy("fit", "node", "part").applyInPandas(choose, out)
    found: dict[tuple[int, int], tuple[int, float, Split | None]] = {}
    for r in sorted(parts.collect(), key=lambda r: (r.fit, r.node, -r.gain, r.feature)):  # a row per fit, node and part of the features
        if (r.fit, r.node) not in found or (found[r.fit, r.node][2] is None and r.feature >= 0):
            found[r.fit, r.node] = (r.n, r.g, Split(r.gain, r.feature, r.bin, (r.gl, r.nl), (r.gr, r.nr)) if r.feature >= 0 else None)
    wanted = [(k, n) for k, _, _, _, _, _, nodes, _ in work for n in nodes]
    return [(k, n, *found.get((k, n), (0, 0.0, None))) for k, n in wanted]


_BEST = ["fit", "node", "n", "g", "gain", "feature", "bin", "gl", "nl", "gr", "nr"]


@dataclass
class Ensemble:
    """A fitted model: the mean it starts from, edges of the bins, and trees."""

    base: float
    edges: list[list[float]]
    trees: list[Tree]

    def predict(self, values: np.ndarray) -> np.ndarray:
        bins = _binned(values, self.edges)
        out = np.full(len(values), self.base)
        for tree in self.trees:
            out += np.array(tree.value)[_routed(_shape(tree), bins)]
        return out

    def importances(self) -> list[float]:
        """By feature, its share of the gains of all splits."""
        gains = np.zeros(len(self.edges))
        for tree in self.trees:
            for node, child in enumerate(tree.children):
                if child:
                    (g, n), (gl, nl), (gr, nr) = tree.total[node], tree.total[child], tree.total[child + 1]
                    gains[tree.feature[node]] += gl**2 / nl + gr**2 / nr - g**2 / n
        return (gains / gains.sum()).tolist() if gains.sum() else gains.tolist()

    def to_json(self) -> str:
        trees = [{k: getattr(t, k) for k in ("feature", "bin", "children", "value", "total")} for t in self.trees]
        return json.dumps({"base": self.base, "edges": self.edges, "trees": trees})

    @classmethod
    def from_json(cls, text: str) -> Ensemble:
        held = json.loads(text)
        return cls(held["base"], held["edges"], [Tree(**t) for t in held["trees"]])


def _grow_trees(running: list[_Fit], width: int, unit: float, look: Callable[[], list[tuple]]) -> None:
    """The next tree of every open fit; ``look`` gives the best splits of the nodes that are not known yet."""
    for f in running:
        if f.open:
            f.tree, rng = Tree(), random.Random(f"{f.growth.seed}:{len(f.trees)}")
            f.columns = sorted(rng.sample(range(width), max(1, round(f.growth.column_share * width))))
    while growing := [f for f in running if f.tree is not None]:
        for k, node, n, g, best in look():
            fit, tree = running[k], running[k].tree
            tree.known[node], tree.total[node] = True, (g, n)
            deep = fit.growth.depth and tree.depth[node] >= fit.growth.depth
            tree.best[node] = None if deep else best
        for f in growing:
            chosen, done = _ahead(f.tree, f.growth)
            for node in range(len(f.tree.feature)):  # nodes at the greatest depth are never split, and need no look
                if f.growth.depth and f.tree.depth[node] >= f.growth.depth and not f.tree.known[node]:
                    f.tree.known[node] = True
            if not done and all(f.tree.known):
                chosen, done = _ahead(f.tree, f.growth)
            if done:
                rate = f.growth.rate if f.trees else f.growth.first or f.growth.rate
                f.trees.append(_pruned(f.tree, chosen, f.growth, unit, rate))
                f.tree = None


class _Held:
    """All rows of a fit in one task: what ``_splits`` finds in a job is added up here, the same whole units."""

    def __init__(self, fit: _Fit, key: np.ndarray, fold: np.ndarray, y: np.ndarray, bins: np.ndarray, n_bins: int, unit: float):
        self.fit, self.n_bins, self.unit = fit, n_bins, unit
        own = fold != fit.fold
        self.key, self.y, self.bins = key[own], y[own], bins[own]
        self.by_column = np.ascontiguousarray(self.bins.T)
        self.score = np.full(len(self.y), fit.base)
        self.settings = replace(fit.growth, gamma=fit.growth.gamma / unit / unit)  # sums are in units
        self.rows: dict[int, np.ndarray] = {}
        self.sums: dict[int, np.ndarray] = {}

    def _sums(self, rows: np.ndarray, columns: list[int]) -> np.ndarray:
        """Gradients and row counts by (column, bin)."""
        gradient, out = self.gradient[rows], np.empty((2, len(columns), self.n_bins))
        if len(rows) < 1 << 12:
            cell = (self.bins[rows][:, columns] + np.arange(len(columns)) * self.n_bins).ravel()
            out[0] = np.bincount(cell, np.repeat(gradient, len(columns)), len(columns) * self.n_bins).reshape(-1, self.n_bins)
            out[1] = np.bincount(cell, minlength=len(columns) * self.n_bins).reshape(-1, self.n_bins)
            return out
        for n, column in enumerate(columns):
            cell = self.by_column[column][rows]
            out[0, n], out[1, n] = np.bincount(cell, gradient, self.n_bins), np.bincount(cell, minlength=self.n_bins)
        return out

    def _spread(self, tree: Tree, columns: list[int]) -> None:
        """Rows and sums of children that have none yet; the larger child's sums are what the smaller one leaves of the parent's."""
        for node, child in enumerate(tree.children):
            if child and node in self.rows:
                rows = self.rows.pop(node)
                left = self.by_column[tree.feature[node]][rows] <= tree.bin[node]
                self.rows[child], self.rows[child + 1] = rows[left], rows[~left]
                small, large = (child, child + 1) if 2 * left.sum() <= len(rows) else (child + 1, child)
                self.sums[small] = self._sums(self.rows[small], columns)
                self.sums[large] = self.sums.pop(node) - self.sums[small]

    def look(self) -> list[tuple]:
        tree, g, columns = self.fit.tree, self.fit.growth, self.fit.columns
        if not tree.known[0]:
            self.gradient = np.round((self.score - self.y) / self.unit)
            some = _drawn(self.key, len(self.fit.trees), g.seed, g.row_share) if g.row_share < 1 else np.ones(len(self.y), bool)
            self.rows = {0: np.flatnonzero(some).astype(np.int32)}
            self.sums = {0: self._sums(self.rows[0], columns)}
        self._spread(tree, columns)
        out = []
        for node in [n for n, known in enumerate(tree.known) if not known]:
            gradient, rows = self.sums[node]
            best = None
            for low in range(0, len(columns), PART):  # as the parts of a job
                found = best_split(gradient[low : low + PART], rows[low : low + PART], self.settings, columns[low : low + PART])
                if found and (best is None or found.gain > best.gain):
                    best = found
            out.append((0, node, int(rows[0].sum()), float(gradient[0].sum()), best))
        return out

    def predicted(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.fit.base)
        for tree in self.fit.trees:
            out += np.array(tree.value)[_routed(_shape(tree), bins)]
        return out

    def grow(self) -> str:
        width = self.bins.shape[1]
        while self.fit.open:
            _grow_trees([self.fit], width, self.unit, self.look)
            tree = self.fit.trees[-1]
            self.score += np.array(tree.value)[_routed(_shape(tree), self.bins)]
        return Ensemble(self.fit.base, [], self.fit.trees).to_json()


def _alone(numbered: DataFrame, running: list[_Fit], edges: list[list[float]], n_bins: int, unit: float, errors: bool) -> DataFrame:
    """Every fit in a task that has all rows; fits share a task where there are many. Gives the trees, or the errors on rows held out."""
    spark, width, kind = numbered.sparkSession, len(edges), np.uint8 if n_bins <= 256 else np.uint16
    parts = min(len(running), 4 * max(1, spark.sparkContext.defaultParallelism))
    # settings of many trees lie side by side, so they are dealt in turn
    tasks = [list(range(p, len(running), parts)) for p in range(parts)]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, fold, y = (batch.column(i).to_numpy(zero_copy_only=False).tobytes() for i in range(3))
            bins = _binned(_floats(batch.column(3), width), edges).astype(kind).tobytes()
            yield pa.RecordBatch.from_pydict({"part": list(range(parts)), **{n: [v] * parts for n, v in zip("abcd", (key, fold, y, bins))}}, dealt)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[bytes, ...]]] = {}
        for batch in batches:
            for part, *blobs in zip(*[c.to_pylist() for c in batch.columns]):
                held.setdefault(part, []).append(blobs)
        for part, blobs in held.items():
            key, fold, y, bins = (np.frombuffer(b"".join(b), t) for b, t in zip(zip(*blobs), (np.int64, np.int32, np.float64, kind)))
            order = np.argsort(key, kind="stable")
            key, fold, y, bins = key[order], fold[order], y[order], bins.reshape(-1, width)[order]
            for k in tasks[part]:
                one, out = _Held(running[k], key, fold, y, bins, n_bins, unit), fold == running[k].fold
                text = one.grow()
                if errors and out.any():
                    missed = one.predicted(bins[out]) - y[out]
                    yield pa.RecordBatch.from_pydict({"fit": [k], "rmse": [float(np.sqrt(np.mean(missed**2)))]}, given)
                elif not errors:
                    yield pa.RecordBatch.from_pydict({"fit": [k], "trees": [text]}, given)

    dealt = pa.schema([("part", pa.int32()), *[(n, pa.binary()) for n in "abcd"]])
    given = pa.schema([("fit", pa.int32()), ("rmse", pa.float64()) if errors else ("trees", pa.string())])
    met = numbered.mapInArrow(deal, "part int, a binary, b binary, c binary, d binary").repartitionById(parts, "part")
    return met.mapInArrow(grow, "fit int, rmse double" if errors else "fit int, trees string")


def _grow_alone(numbered: DataFrame, running: list[_Fit], edges: list[list[float]], n_bins: int, unit: float) -> None:
    for r in _alone(numbered, running, edges, n_bins, unit, False).collect():  # one row per fit
        running[r.fit].trees = Ensemble.from_json(r.trees).trees
    for tree in (t for f in running for t in f.trees):
        tree.depth = [0] * len(tree.children)
        for node, child in enumerate(tree.children):
            if child:
                tree.depth[child] = tree.depth[child + 1] = tree.depth[node] + 1


def _begun(
    rows: DataFrame, fits: list[tuple[Growth, int]], features: str, label: str, key: Column, fold: Column | None, bins: int
) -> tuple[DataFrame, int, list[_Fit], list[list[float]], int, float]:
    """Numbered rows and how many, the fits with the means they start from, edges and number of bins, and the unit of the sums."""
    ship(rows.sparkSession)
    numbered = rows.where(F.col(label).isNotNull()).select(
        F.xxhash64(key).alias("key"), (fold if fold is not None else F.lit(0)).cast("int").alias("fold"),
        F.col(label).cast("double").alias("y"), F.transform(features, lambda x: F.coalesce(x.cast("double"), F.lit(float("nan")))).alias("x"),
    )
    of_fold = [F.count(F.lit(1)).alias("n"), F.min("y").alias("low"), F.max("y").alias("high"), F.max(F.size("x")).alias("w")]
    shape = numbered.groupBy("fold").agg(*of_fold).collect()  # one row per fold
    if not shape:
        raise ValueError("no rows to fit")
    width, edges = shape[0].w, bin_edges(numbered, "x", shape[0].w, bins)
    n_bins = max(map(len, edges)) + 1
    low = min(r.low for r in shape)
    spread = max(r.high for r in shape) - low or 1.0
    unit = 4 * spread * sum(r.n for r in shape) / 2.0**52
    above = numbered.groupBy("fold").agg(F.sum(F.rint((F.col("y") - F.lit(low)) / F.lit(unit))).alias("s"))
    sums = {r.fold: r.s for r in above.collect()}
    running = []
    for growth, out in fits:
        left = [r for r in shape if r.fold != out]
        n = sum(r.n for r in left)
        running.append(_Fit(growth, out, low + unit * sum(sums[r.fold] for r in left) / n if n else 0.0))
    return numbered, sum(r.n for r in shape), running, edges, n_bins, unit


def held_out_errors(
    rows: DataFrame, fits: list[tuple[Growth, int]], features: str, label: str, key: Column, fold: Column, bins: int = 255
) -> list[float | None] | None:
    """By (settings, fold held out) of ``fits``, the RMSE on the rows of that fold, None if it has none; no tree comes to the driver.

    None in all if there are too many rows for a task.
    """
    numbered, size, running, edges, n_bins, unit = _begun(rows, fits, features, label, key, fold, bins)
    if size * len(edges) > HELD:
        return None
    found = {r.fit: r.rmse for r in _alone(numbered, running, edges, n_bins, unit, True).collect()}  # one row per fit
    return [found.get(k) for k in range(len(fits))]


def fit_many(
    rows: DataFrame, fits: list[tuple[Growth, int]], features: str, label: str, key: Column, fold: Column | None = None, bins: int = 255
) -> list[Ensemble]:
    """A model for each (settings, fold held out) of ``fits``; fold -1 holds nothing out. ``features`` is an array column.

    A missing value counts as larger than all others. Rows without a label do not count.
    """
    numbered, size, running, edges, n_bins, unit = _begun(rows, fits, features, label, key, fold, bins)
    width = len(edges)
    if size * width <= HELD:
        _grow_alone(numbered, running, edges, n_bins, unit)
        return [Ensemble(f.base, edges, f.trees) for f in running]
    bases = np.array([f.base for f in running])

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            binned = _binned(_floats(batch.column(3), width), edges).astype(np.uint16)
            scores = np.tile(bases, (len(binned), 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _packed(binned), _packed(scores)], names=["key", "fold", "y", "bins", "scores"])

    # partitions by size: every tree is several jobs, and on few rows their tasks cost more than the rows
    parts = max(1, -(-size * (2 * width + 8 * len(running) + 64) // TASK_BYTES))
    # known to be one partition, few rows need no shuffle to meet
    state = written(numbered.repartition(parts, "key").mapInArrow(start, _STATE), "boosting").coalesce(parts)
    since = [0] * len(running)
    while any(f.open for f in running):
        _grow_trees(running, width, unit, lambda: _splits(state, running, since, width, n_bins, unit))
        if any(len(f.trees) - s >= STRIDE for f, s in zip(running, since)):
            state = _scores_after(state, running, since, width).coalesce(parts)
            since = [len(f.trees) for f in running]
    return [Ensemble(f.base, edges, f.trees) for f in running]


class _Settings(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector of features", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction", TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "trees", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "share of a leaf's value that is added", TypeConverters.toFloat)
    firstStep = Param(Params._dummy(), "firstStep", "the same of the first tree; 0: as the others", TypeConverters.toFloat)
    numLeaves = Param(Params._dummy(), "numLeaves", "leaves of a tree, the best first; 0: level by level", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "greatest depth; 0: no limit", TypeConverters.toInt)
    regLambda = Param(Params._dummy(), "regLambda", "added to the second derivatives", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "least gain of a split", TypeConverters.toFloat)
    minChildWeight = Param(Params._dummy(), "minChildWeight", "least second derivatives of a child", TypeConverters.toFloat)
    minChildRows = Param(Params._dummy(), "minChildRows", "least rows of a child", TypeConverters.toInt)
    subsample = Param(Params._dummy(), "subsample", "share of the rows per tree", TypeConverters.toFloat)
    columnShare = Param(Params._dummy(), "columnShare", "share of the features per tree", TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "bins per feature", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)


_DEFAULTS = dict(
    featuresCol="features", labelCol="label", predictionCol="prediction", maxIter=100, stepSize=0.1, firstStep=0.0, numLeaves=31, maxDepth=0,
    regLambda=0.0, gamma=0.0, minChildWeight=1e-3, minChildRows=20, subsample=1.0, columnShare=1.0, maxBins=255, seed=42,
)


class HistogramBoosting(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """The estimator for Spark ML pipelines; ``fit_many`` underneath."""

    @keyword_only
    def __init__(
        self, *, featuresCol="features", labelCol="label", predictionCol="prediction", maxIter=100, stepSize=0.1, firstStep=0.0, numLeaves=31,
        maxDepth=0, regLambda=0.0, gamma=0.0, minChildWeight=1e-3, minChildRows=20, subsample=1.0, columnShare=1.0, maxBins=255, seed=42,
    ):
        super().__init__()
        self._setDefault(**_DEFAULTS)
        self._set(**self._input_kwargs)

    def growth(self) -> Growth:
        take = self.getOrDefault
        return Growth(
            rounds=take("maxIter"), rate=take("stepSize"), first=take("firstStep"), leaves=take("numLeaves"), depth=take("maxDepth"), lam=take("regLambda"),
            gamma=take("gamma"), child_weight=take("minChildWeight"), child_rows=take("minChildRows"), row_share=take("subsample"),
            column_share=take("columnShare"), seed=take("seed"),
        )

    def fit_settings(self, dataset: DataFrame, settings: list[tuple[dict, int]], key: Column, fold: Column | None = None) -> list[BoostedModel]:
        """A model for each (parameters by name, fold held out), all grown side by side."""
        growths = [(self.copy({self.getParam(k): v for k, v in s.items()}).growth(), out) for s, out in settings]
        rows = dataset.withColumn("_x", vector_to_array(self.getOrDefault("featuresCol")))
        label, bins = self.getOrDefault("labelCol"), self.getOrDefault("maxBins")
        return [self._model(e) for e in fit_many(rows, growths, "_x", label, key, fold, bins)]

    def settings_errors(self, dataset: DataFrame, settings: list[tuple[dict, int]], key: Column, fold: Column) -> list[float | None] | None:
        """The RMSE of each on the rows of the fold held out, from tasks that grow and score; None if there are too many rows for that."""
        growths = [(self.copy({self.getParam(k): v for k, v in s.items()}).growth(), out) for s, out in settings]
        rows = dataset.withColumn("_x", vector_to_array(self.getOrDefault("featuresCol")))
        return held_out_errors(rows, growths, "_x", self.getOrDefault("labelCol"), key, fold, self.getOrDefault("maxBins"))

    def _model(self, ensemble: Ensemble) -> BoostedModel:
        model = BoostedModel()._set(trees=ensemble.to_json())
        return model._set(featuresCol=self.getOrDefault("featuresCol"), predictionCol=self.getOrDefault("predictionCol"))

    def _fit(self, dataset: DataFrame) -> BoostedModel:
        # without an id, rows are drawn by what they hold; equal rows are drawn together
        held = F.struct(self.getOrDefault("labelCol"), vector_to_array(self.getOrDefault("featuresCol")).alias("x"))
        return self.fit_settings(dataset, [({}, -1)], F.to_json(held))[0]


class BoostedModel(Model, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Scores rows in Arrow batches; saved and loaded as any Spark ML model."""

    trees = Param(Params._dummy(), "trees", "the ensemble as JSON", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction")

    @property
    def ensemble(self) -> Ensemble:
        return Ensemble.from_json(self.getOrDefault("trees"))

    @property
    def featureImportances(self):
        return DenseVector(self.ensemble.importances())

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ensemble = self.ensemble
        ship(dataset.sparkSession)

        @F.pandas_udf("double")
        def predict(features: pd.Series) -> pd.Series:
            return pd.Series(ensemble.predict(np.array(features.tolist(), float).reshape(len(features), -1)))

        return dataset.withColumn(self.getOrDefault("predictionCol"), predict(vector_to_array(self.getOrDefault("featuresCol"))))
