"""Whitening of vectors: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Entries become integers ``floor(64 c) + 1000000``. The fit list has each distinct integer vector once; tasks sum up
its integers, then the products of its centred vectors, so the driver gets sums per dimension and one square matrix of
the dimensions, whatever the number of rows. There the matrix is split as ``G G'`` with ``G`` a permuted triangle, and
rotations make the columns of ``G`` orthogonal: their squared lengths are the eigenvalues, their directions the
components. The covariance of the whitened fit list is measured in a pass of its own.

Defined cases: rows whose vector is null or holds null or non-finite entries are dropped; repeated vectors count once
in the fit and are all returned; vectors shorter than the longest are filled up with entries of 0; an entry whose
integer would pass 2^52 either way is taken as that bound; components without variance are left out, so equal vectors
give no rows; of equal eigenvalues any order, the same for all rows; ``deviation`` is null where it passes 64 bits;
a null id is kept as it is; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import cut

SCALE, SHIFT, COMPONENTS = 64.0, 1_000_000, 16
BOUND = float(1 << 52)
#: Share of a dimension's own variance below which nothing is left of it, and of two columns' lengths at which they are orthogonal.
REST, ORTHOGONAL = 1e-11, 1e-15
SWEEPS = 60
#: Tasks whose partial sums one group adds up.
FAN_IN = 256
#: Entries that are worked on at a time.
CELLS = 1 << 20


@dataclass
class Fit:
    """Number of vectors, sums of their entries, components by rows, eigenvalues, trace, and the measured identity error."""
    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The means' nearest integers, and what they lack of the means, times n."""
        whole = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        return np.array(whole, np.int64), np.array([s - self.n * w for s, w in zip(self.sums, whole)], np.int64)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self) @ (self.components / np.sqrt(self.eigenvalues)[:, None]).T

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over the dimensions of the squares of (n x - S), exact."""
        whole, lack = self.centre()
        d = x - whole
        most = float(np.abs(d).max(initial=0) + 1) * self.n
        if most ** 2 * max(1, x.shape[1]) < float(1 << 62):
            return ((self.n * d - lack) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * a - b) ** 2 for a, b in zip(row, lack.tolist())) for row in d.tolist()]
        return [e if e < 1 << 63 else None for e in exact]


def _centred(x: np.ndarray, fit: Fit) -> np.ndarray:
    whole, lack = fit.centre()
    return (x - whole).astype(np.float64) - lack / fit.n


def integers(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of an Arrow list column whose vectors count, and their integers."""
    column = column.cast(pa.list_(pa.float64()))
    valid = np.array(column.is_valid())
    edges = column.offsets.to_numpy()
    values = column.values
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64)  # null entries become NaN
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    keep = np.flatnonzero(valid & (bad[edges[1:]] == bad[edges[:-1]]))
    lengths = (edges[1:] - edges[:-1])[keep]
    out = np.full((len(keep), dim), SHIFT, np.int64)
    row = np.repeat(np.arange(len(keep)), lengths)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    entry = np.clip(np.floor(SCALE * flat[np.repeat(edges[:-1][keep], lengths) + place]), -BOUND, BOUND).astype(np.int64)
    out[row, place] = entry + SHIFT
    return keep, out


def _packed(x: np.ndarray) -> list[bytes]:
    """Each vector in as few bytes an entry as hold all its entries; equal vectors are equal bytes."""
    d = x - SHIFT
    span = np.maximum(d.max(axis=1, initial=0), -1 - d.min(axis=1, initial=0))
    out: list[bytes] = [b""] * len(x)
    width = np.where(span < 1 << 7, 1, np.where(span < 1 << 15, 2, np.where(span < 1 << 31, 4, 8)))
    for w in np.unique(width).tolist():
        for i, row in zip(np.flatnonzero(width == w).tolist(), d[width == w].astype(f"<i{w}")):
            out[i] = row.tobytes()
    return out


def _unpacked(packed: list[bytes], dim: int) -> np.ndarray:
    """The vectors of ``_packed``; a width is known by the length, for all have ``dim`` entries."""
    out = np.empty((len(packed), dim), np.int64)
    lengths = np.array([len(p) for p in packed], np.int64)
    for length in np.unique(lengths).tolist():
        some = np.flatnonzero(lengths == length)
        if dim:
            out[some] = np.frombuffer(b"".join(packed[i] for i in some), f"<i{length // dim}").reshape(-1, dim)
    return out + SHIFT


def fit_list(vectors: DataFrame, dim: int, vector_col: str = "embedding") -> DataFrame:
    """The distinct integer vectors, packed."""
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, dim):
                _, x = integers(part.column(0), dim)
                yield pa.RecordBatch.from_arrays([pa.array(sorted(set(_packed(x))), pa.binary())], ["x"])

    return cut(vectors.select(vector_col).mapInArrow(distinct, "x binary").distinct(), "fit_list")


def _parts(batch: pa.RecordBatch, dim: int) -> Iterator[pa.RecordBatch]:
    rows = max(1, CELLS // max(1, dim))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _sums(fitted: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Vectors of the fit list, and sums of their entries."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for batch in batches:
            for part in _parts(batch, dim):
                d = _unpacked(part.column(0).to_pylist(), dim) - SHIFT
                # halves of the numbers, for a sum of whole ones could pass 64 bits
                high, low = (d >> 26).sum(axis=0).tolist(), (d & ((1 << 26) - 1)).sum(axis=0).tolist()
                total = [t + (h << 26) + k for t, h, k in zip(total, high, low)]
                n += part.num_rows
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1, *range(dim)], pa.int32()), pa.array([str(n), *map(str, total)], pa.string())], ["at", "total"])

    rows = fitted.mapInArrow(add, "at int, total string").groupBy("at").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total")).collect()  # a row per dimension
    found = {r["at"]: int(r["total"]) for r in rows}
    n = found.get(-1, 0)
    return n, [found.get(k, 0) + n * SHIFT for k in range(dim)]


def _products(rows: DataFrame, project, size: int) -> np.ndarray:
    """Sum over all tasks of ``y' y`` for their blocks ``y = project(batch part)``, with a column of ones as its last."""
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            for part in _parts(batch, size):
                y = project(part)
                y = np.concatenate((y, np.ones((len(y), 1))), axis=1)
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size + 1, task // FAN_IN, np.int32)), pa.array(np.arange(size + 1, dtype=np.int32)),
                 pa.array(np.full(size + 1, task, np.int32)), pa.array([r.tobytes() for r in total], pa.binary())], ["part", "at", "task", "sums"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("task")
        total = np.sum([np.frombuffer(b, np.float64) for b in table.column("sums").to_pylist()], axis=0)
        return table.slice(0, 1).set_column(3, "sums", pa.array([total.tobytes()], pa.binary()))

    schema = "part int, at int, task int, sums binary"
    partial = rows.mapInArrow(multiply, schema).groupBy("part", "at").applyInArrow(add, schema)
    whole = partial.groupBy("at").applyInArrow(add, schema)
    out = np.zeros((size + 1, size + 1))
    for r in whole.collect():  # a row per dimension
        out[r["at"]] = np.frombuffer(r["sums"], np.float64)
    return out


def _covariance(products: np.ndarray, n: int) -> np.ndarray:
    """Covariance from products and, in the last row, sums; the sums of centred rows are but rounding."""
    mean = products[-1, :-1] / n
    return products[:-1, :-1] / n - np.outer(mean, mean)


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """``G`` with ``a = G G'``: rows of a lower triangle in the order of the pivots, put back in place; as many columns as the rank."""
    n = len(a)
    own = np.diag(a).copy()
    left, done = own.copy(), np.zeros(n, bool)
    columns: list[np.ndarray] = []
    while True:
        open_ = np.flatnonzero(~done & (left > REST * own))
        if not len(open_):
            return np.array(columns).T.reshape(n, len(columns))
        k = int(open_[np.argmax(left[open_])])
        column = a[:, k] - sum(c * c[k] for c in columns) if columns else a[:, k].copy()
        column[done] = 0
        column /= np.sqrt(left[k])
        column[k] = np.sqrt(left[k])
        columns.append(column)
        done[k] = True
        left = left - column ** 2


def one_sided_jacobi(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit columns that span ``g`` and their squared lengths, falling: rotations of column pairs until all are orthogonal.

    Pairs are taken as in a round-robin tournament, so that the pairs of a round are rotated together.
    """
    g = g.copy()
    n = g.shape[1]
    ring = np.arange(n + n % 2)
    for _ in range(SWEEPS):
        most = 0.0
        for _ in range(len(ring) - 1):
            i, j = ring[:len(ring) // 2], ring[len(ring) // 2:][::-1]
            real = (i < n) & (j < n)
            i, j = i[real], j[real]
            x, y = g[:, i], g[:, j]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            angle = np.abs(xy) / np.maximum(np.sqrt(xx * yy), np.finfo(float).tiny)
            most = max(most, float(angle.max(initial=0)))
            turn = np.flatnonzero(angle > ORTHOGONAL)
            if len(turn):
                zeta = (yy[turn] - xx[turn]) / (2 * xy[turn])
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
                c = 1 / np.hypot(1, t)
                s = c * t
                x, y = x[:, turn], y[:, turn]
                g[:, i[turn]], g[:, j[turn]] = c * x - s * y, s * x + c * y
            ring = np.concatenate((ring[:1], ring[-1:], ring[1:-1]))
        if most <= 8 * ORTHOGONAL:
            break
    squares = (g * g).sum(axis=0)
    order = np.argsort(-squares, kind="stable")
    units = g[:, order] / np.sqrt(squares[order])
    if n:
        units = units * np.where(units[np.abs(units).argmax(axis=0), np.arange(n)] < 0, -1.0, 1.0)
    return units, squares[order]


def fit(vectors: DataFrame, dim: int, vector_col: str = "embedding", components: int = COMPONENTS) -> Fit:
    """Means, components and eigenvalues of the distinct integer vectors."""
    listed = fit_list(vectors, dim, vector_col)
    n, sums = _sums(listed, dim)
    model = Fit(n, sums, np.empty((0, dim)), np.empty(0), 0.0)
    if not n or not dim:
        return model
    products = _products(listed, lambda part: _centred(_unpacked(part.column(0).to_pylist(), dim), model), dim)
    variance = _covariance(products, n)
    units, values = one_sided_jacobi(pivoted_cholesky(variance))
    model = Fit(n, sums, units.T[:components].copy(), values[:components], float(np.trace(variance)))
    if len(values):
        whitened = _products(listed, lambda part: model.whiten(_unpacked(part.column(0).to_pylist(), dim)), len(model.eigenvalues))
        model.identity_error = float(np.abs(_covariance(whitened, n) - np.eye(len(model.eigenvalues))).max())
    return model


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           model: Fit | None = None) -> DataFrame:
    """A row per vector that counts and component: its place on the component, with the fit's figures."""
    dim = (len(model.sums) if model else vectors.agg(F.max(F.size(vector_col))).first()[0]) or 0
    dim = max(dim, 0)
    model = model or fit(vectors, dim, vector_col, components)
    k = len(model.eigenvalues)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, dim):
                keep, x = integers(part.column(1), dim)
                if not len(keep) or not k:
                    continue
                ids = part.column(0).take(pa.array(np.repeat(keep, k)))
                rows = len(keep)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, model.n, np.int64)),
                     pa.array([d for d in model.deviations(x) for _ in range(k)], pa.int64()), pa.array(model.whiten(x).ravel()),
                     pa.array(np.tile(model.eigenvalues / model.trace, rows)), pa.array(np.full(rows * k, model.identity_error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), vector_col).mapInArrow(
        project, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
