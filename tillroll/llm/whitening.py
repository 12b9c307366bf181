"""Whitening of embeddings, from exact variances alone.

Components become whole numbers, x = floor(scale * c). The fit is made on every distinct x vector once. A first pass
counts them and adds up every dimension; a second one adds up squares of centred values, for every dimension and for the
sum of every pair of dimensions. By polarisation cov(i, j) = (var(i + j) - var(i) - var(j)) / 2, so that these sums give
all covariances; only then the matrix, as large as the dimensions and not the rows, is assembled for ``eigh``.

All sums are exact. Values are centred on the whole number next to their mean, which keeps them small, and what the
mean is away from it is taken off the total in whole numbers, so that the total is that of (n * x - S) ** 2.
Tasks add in 64 bits where the largest value shows that it suffices, else in whole numbers of any size; between tasks the
sums travel in pieces of 40 bits.

Rows whose vector is null or holds null or non-finite components are left out; rows with null or repeated ids stay. A
vector that is shorter than another counts as zero where it ends; where all are empty, or the table is, there are no
components and no rows. x is held in 64 bits, larger numbers become the largest. A component without variance has the
value 0 in every row, and the identity error is 1 then. ``deviation`` is null beyond 38 digits. Other columns are not read.
"""

from __future__ import annotations

import decimal
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.topk import valid
from tillroll.staging import written

SCALE = 256.0
COMPONENTS = 4
_SAFE = 1 << 62
_PIECE, _PIECES = 40, 5


def _whole(vector: Column, scale: float) -> Column:
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * F.lit(scale)).cast("long"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a batch as whole numbers, short ones filled with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _largest(matrix: np.ndarray) -> int:
    return max(abs(int(matrix.min(initial=0))), abs(int(matrix.max(initial=0))))


def _less(matrix: np.ndarray, off: list[int]) -> np.ndarray:
    """``matrix`` minus one number per column, in 64 bits if these suffice."""
    if _largest(matrix) + max(map(abs, off), default=0) < _SAFE:
        return matrix - np.array(off, np.int64)
    return matrix.astype(object) - np.array(off, object)


def _sums(matrix: np.ndarray) -> np.ndarray:
    return matrix.sum(axis=0).astype(object) if _largest(matrix) * max(len(matrix), 1) < _SAFE else matrix.astype(object).sum(axis=0)


def _squares(matrix: np.ndarray) -> list[np.ndarray]:
    """By dimension i: the sums of squares of i alone, and of i plus every later one."""
    most = 2 * _largest(matrix)
    if most * most * max(len(matrix), 1) >= _SAFE:
        matrix = matrix.astype(object)
    out = []
    for i in range(matrix.shape[1]):
        pair = matrix[:, i + 1 :] + matrix[:, [i]]
        both = np.concatenate([matrix[:, [i]], pair], axis=1)
        out.append((both * both).sum(axis=0))
    return [np.asarray(s, object) for s in out]


def _totals(parts: DataFrame) -> dict[tuple[int, int], int]:
    """The sums of all tasks by (i, j): as many as there are pairs of dimensions."""
    pieces = [F.sum(F.col("s")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(_PIECES)]
    rows = parts.groupBy("i", "j").agg(*pieces).collect()
    return {(r.i, r.j): sum(int(r[f"s{k}"]) << (_PIECE * k) for k in range(_PIECES)) for r in rows}


def _piecewise(number: int) -> list[int]:
    low = [(number >> (_PIECE * k)) & ((1 << _PIECE) - 1) for k in range(_PIECES - 1)]
    return [*low, number >> (_PIECE * (_PIECES - 1))]


_PARTS = "i int, j int, s array<long>"


def _emit(entries: Iterator[tuple[int, int, int]]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("s", pa.list_(pa.int64()))])
    while some := list(itertools.islice(entries, 1 << 16)):
        i, j, s = zip(*some)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(list(map(_piecewise, s)), schema.field("s").type)], schema=schema)


def _added(x: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of rows and the sum of every dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = 0, np.zeros(width, object)
        for batch in batches:
            matrix = _matrix(batch.column(0), width)
            rows, total = rows + len(matrix), total + _sums(matrix)
        yield from _emit(((k, -1, int(v)) for k, v in enumerate([rows, *total])))

    got = _totals(x.mapInArrow(add, _PARTS))
    return got[0, -1], [got[k + 1, -1] for k in range(width)]


def _centred_squares(x: DataFrame, n: int, sums: list[int]) -> dict[tuple[int, int], int]:
    """By (i, j): the sum of (n * v - V) ** 2 over all rows, of v = x_i, or x_i + x_j where j > i, with V its sum."""
    width = len(sums)
    near = [(2 * s + n) // (2 * n) for s in sums]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(width - i, object) for i in range(width)]
        for batch in batches:
            here = _squares(_less(_matrix(batch.column(0), width), near))
            total = [a + b for a, b in zip(total, here)]
        yield from _emit(((i, i + k, int(v)) for i, row in enumerate(total) for k, v in enumerate(row)))

    rest = [s - n * m for s, m in zip(sums, near)]  # the sums of the values as centred
    got = _totals(x.mapInArrow(add, _PARTS))
    off = lambda i, j: rest[i] if i == j else rest[i] + rest[j]
    return {(i, j): n * n * q - n * off(i, j) ** 2 for (i, j), q in got.items()}


@dataclass(frozen=True)
class Whitening:
    """A fitted transformation; its size depends on the dimensions only."""

    n: int
    sums: list[int]
    trace: float  # of the covariance
    values: np.ndarray  # eigenvalues of the components, falling
    vectors: np.ndarray  # a column each

    @property
    def explained(self) -> list[float]:
        return [float(e) / self.trace if self.trace else 0.0 for e in self.values]

    def projected(self, matrix: np.ndarray) -> tuple[list[int], np.ndarray]:
        """The exact squared distances from the mean, times n squared, and the whitened components."""
        near = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        rest = [s - self.n * m for s, m in zip(self.sums, near)]
        small = _less(matrix, near)
        most = self.n * _largest(small) + max(map(abs, rest), default=0)
        exact = small if most * most * max(len(rest), 1) < _SAFE else small.astype(object)
        centred = exact * (self.n if exact.dtype == object else np.int64(self.n)) - np.array(rest, exact.dtype)
        root = np.sqrt(self.values)
        turned = (centred.astype(np.float64) / self.n) @ self.vectors
        return (centred * centred).sum(axis=1).tolist(), np.divide(turned, root, out=np.zeros_like(turned), where=root > 0)

    def identity_error(self, x: DataFrame) -> float:
        """The largest entry by which the covariance of the whitened rows ``x`` differs from the identity."""
        k = len(self.values)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((k + 1, k))
            for batch in batches:
                w = self.projected(_matrix(batch.column(0), len(self.sums)))[1]
                total += np.vstack([w.T @ w, w.sum(axis=0)])
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_pydict({"i": pa.array(i.ravel(), pa.int32()), "j": pa.array(j.ravel(), pa.int32()), "s": pa.array(total.ravel())})

        rows = x.mapInArrow(add, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
        total = np.zeros((k + 1, k))
        for r in rows:
            total[r.i, r.j] = r.s / self.n
        # the mean is 0 but for rounding, so taking its square off afterwards loses nothing
        return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max(initial=0))


def _prepared(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> tuple[DataFrame, int]:
    """(id, x) of the rows that take part, all of one length, and that length."""
    kept = vectors.where(valid(F.col(vector_col).cast("array<double>")))
    width = kept.agg(F.max(F.size(vector_col))).first()[0] or 0
    x = _whole(F.col(vector_col), scale)
    filled = F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(x)))
    return kept.select(F.col(id_col).alias("id"), filled.alias("x")), width


def covariance(x: DataFrame, width: int) -> tuple[int, list[int], np.ndarray]:
    """Of the vectors of the column ``x``: their number, the sums of the dimensions, and the covariance with divisor n."""
    n, sums = _added(x, width)
    square = _centred_squares(x, n, sums)
    matrix = np.empty((width, width))
    for i in range(width):
        matrix[i, i] = square[i, i] / n**3  # whole numbers, divided with one rounding
        for j in range(i + 1, width):
            matrix[i, j] = matrix[j, i] = (square[i, j] - square[i, i] - square[j, j]) / (2 * n**3)
    return n, sums, matrix


def fit(x: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """``x``: every vector once, at least one, of ``width`` dimensions."""
    n, sums, matrix = covariance(x, width)
    values, turned = np.linalg.eigh(matrix)
    best = np.argsort(-values, kind="stable")[:components]
    floor = np.finfo(float).eps * width * max(float(values.max()), 0.0)
    return Whitening(n, sums, float(np.trace(matrix)), np.where(values[best] > floor, values[best], 0.0), turned[:, best])


def whitened(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = SCALE, components: int = COMPONENTS
) -> DataFrame:
    """A row per vector and component: the id, ``component`` from 1, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    rows, width = _prepared(vectors, id_col, vector_col, scale)
    if width:
        x = written(rows.select("x").distinct(), "distinct-vectors")
        model = fit(x, width, components)
        error = model.identity_error(x)

        def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                far, w = model.projected(_matrix(batch.column(1), width))
                far = [decimal.Decimal(d) if d < 10**38 else None for d in far]
                arrays = [batch.column(0), pa.array(far, pa.decimal128(38, 0)), pa.array(list(w), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "deviation", "w"])

        shares, n = model.explained, model.n
        rows = rows.mapInArrow(project, f"id {rows.schema['id'].dataType.simpleString()}, deviation decimal(38,0), w array<double>")
    else:
        shares, n, error = [], 0, 0.0
        rows = rows.select("id", F.lit(None).cast("decimal(38,0)").alias("deviation"), F.array().cast("array<double>").alias("w"))
    return rows.select("id", "deviation", F.posexplode("w").alias("place", "whitened")).select(
        F.col("id").alias(id_col),
        (F.col("place") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*map(F.lit, shares)).cast("array<double>"), "place").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
