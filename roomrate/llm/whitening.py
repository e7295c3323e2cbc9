"""Embedding whitening (operator 12): distributed covariance, float32
eigenvectors, mixed-precision refinement.

Every entry c becomes the integer x = floor(1024 * c) + 100000. Tasks add up
integers only: the sums S, then, centred on the rounded means r, the products
of z = x - r. With A the sum of z z', s = S - n r and n rows, the covariance is
(n A - s s') / n**2, known exactly, whatever the partitioning and however many
tasks ran twice. What reaches the driver is one row per pair of dimensions.

The eigenvectors start from a float32 solver and are corrected by
Ogita-Aishima iterations in extended precision, matrix products only:

    R = I - X'X,  S = X'VX,  e_i = S_ii / (1 - R_ii)
    E_ij = (S_ij + e_j R_ij) / (e_j - e_i), or R_ij / 2 if e_i and e_j are
           too close to be told apart at the error left
    X <- X + X E

Eigenvalues too close to be told apart form clusters; each cluster's small
matrix, its common value taken off first so that the differences fill the
mantissa, is solved in double precision and turns the cluster's vectors before
the next iteration.

Defined results: rows whose vector is null or holds null, NaN or infinite
entries are left out; so are entries that no integer holds (|c| >= 2**35) and
vectors of another length than the most common one (ties: the longer), an empty
one included. Repeated rows and null ids are rows like any other. Nothing left:
no rows. Components of eigenvalue zero (constant dimensions, fewer rows than
dimensions) cannot be scaled: whitened is null and they are left out of
identity_error. A deviation beyond a long is null. Signs: the largest entry of
an eigenvector is positive. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
#: Rows of a block of products; their sums stay exact in a double or a long.
BLOCK_ROWS = 4096
#: Entries are below this, so that block sums of integers fit a long.
LARGEST = 2.0 ** 35
WIDE = np.longdouble


def _matrices(batch: pa.RecordBatch, dim: int | None = None):
    """(row numbers, x as int64 matrix) of the usable vectors, by length."""
    col = batch.column(1)
    flat = np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64)  # null entries: nan
    size = np.where(col.is_valid().to_numpy(zero_copy_only=False), col.value_lengths().fill_null(0)
                    .to_numpy(zero_copy_only=False), 0).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(size)])
    for d in np.unique(size) if dim is None else [dim]:
        rows = np.flatnonzero(size == d)
        if not d or not len(rows):
            continue
        for lo in range(0, len(rows), BLOCK_ROWS):
            at = rows[lo:lo + BLOCK_ROWS]
            c = flat[begin[at][:, None] + np.arange(d)]
            good = (np.abs(c) < LARGEST).all(axis=1)  # false for nan
            if good.any():
                yield at[good], np.floor(SCALE * c[good]).astype(np.int64) + SHIFT


def _sums(vectors: DataFrame) -> DataFrame:
    """(dim, i, v): sums per dimension, and at i = -1 the number of rows, of
    the vectors of each length."""

    def run(batches):
        tally: dict[int, np.ndarray] = {}
        for b in batches:
            for at, x in _matrices(b):
                d = x.shape[1]
                total = np.concatenate([[len(at)], x.sum(axis=0)]).astype(object)
                tally[d] = tally[d] + total if d in tally else total
        for d, total in tally.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d + 1, d), pa.int32()), pa.array(np.arange(-1, d), pa.int32()),
                 pa.array([str(v) for v in total])], ["dim", "i", "v"])

    return (vectors.mapInArrow(run, "dim int, i int, v string")
            .groupBy("dim", "i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")))


def exact_products(z: np.ndarray) -> np.ndarray:
    """z'z of an integer matrix, exactly, as Python integers."""
    top = int(np.abs(z).max(initial=0))
    if top * top * len(z) < 1 << 53:
        f = z.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    # in halves of 24 bits, few rows at a time, each product exact in a double
    high, low = z >> 24, z & ((1 << 24) - 1)
    out = np.zeros((z.shape[1],) * 2, object)
    for lo in range(0, len(z), 16):
        h, m = high[lo:lo + 16].astype(np.float64), low[lo:lo + 16].astype(np.float64)
        mixed = (h.T @ m).astype(np.int64).astype(object)
        out = (out + (h.T @ h).astype(np.int64).astype(object) * (1 << 48)
               + (mixed + mixed.T) * (1 << 24) + (m.T @ m).astype(np.int64).astype(object))
    return out


def _products(vectors: DataFrame, centre: np.ndarray) -> DataFrame:
    """(i, j, v): sums of z_i z_j over all vectors, i <= j."""
    d = len(centre)
    upper = np.triu_indices(d)

    def run(batches):
        total = None
        for b in batches:
            for _, x in _matrices(b, d):
                p = exact_products(x - centre)
                total = p if total is None else total + p
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()),
                 pa.array([str(v) for v in total[upper]])], ["i", "j", "v"])

    return (vectors.mapInArrow(run, "i int, j int, v string")
            .groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")))


def _ratio(num: int, den: int) -> np.longdouble:
    """num / den to extended precision: the nearest double and what it misses."""
    high = num / den
    return WIDE(high) + WIDE(float(Fraction(num, den) - Fraction(high)))


def _clusters(e: np.ndarray, error) -> list[np.ndarray]:
    """Runs of eigenvalues (by falling size) that lie within ``error``."""
    cut = np.flatnonzero(e[:-1] - e[1:] > error) + 1
    return [g for g in np.split(np.arange(len(e)), cut) if len(g) > 1]


def _step(v: np.ndarray, x: np.ndarray):
    """One Ogita-Aishima iteration: (vectors, eigenvalues, error of the given
    vectors, at which eigenvalues are told apart)."""
    n = len(v)
    r = np.eye(n, dtype=WIDE) - x.T @ x
    s = x.T @ (v @ x)
    r, s = (r + r.T) / 2, (s + s.T) / 2  # rounding must not leave E + E' other than R
    e = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(np.diag(s))
    error = 2 * (np.sqrt((off ** 2).sum()) + np.abs(e).max() * np.sqrt((r ** 2).sum()))
    gap = e[None, :] - e[:, None]
    apart = np.abs(gap) > error
    np.fill_diagonal(apart, False)
    step = np.where(apart, (s + e[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + x @ step, e, error


def refined_eigen(v: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric
    extended-precision matrix: float32 start, refined until the error is that
    of rounding."""
    size = np.abs(v).max()
    if not size:
        return np.zeros(len(v), WIDE), np.eye(len(v), dtype=WIDE)
    v = v / size
    x = np.linalg.eigh(v.astype(np.float32))[1][:, ::-1].astype(WIDE)
    tiny = np.finfo(WIDE).eps * 8
    for _ in range(rounds):
        x, e, error = _step(v, x)
        order = np.argsort(-e, kind="stable")
        x, e = x[:, order], e[order]
        close = _clusters(e, max(error, tiny))
        turned = False
        for g in close:
            own = x[:, g]
            small = own.T @ (v @ own)
            middle = np.diag(small).mean()
            small = (small + small.T) / 2 - middle * np.eye(len(g), dtype=WIDE)
            spread = np.abs(small).max()
            if np.abs(small - np.diag(np.diag(small))).max() <= tiny * 4:
                continue  # as good as equal, or told apart already
            turn = np.linalg.eigh((small / spread).astype(np.float64))[1][:, ::-1]
            x[:, g] = own @ turn.astype(WIDE)
            turned = True
        if error < 4 * len(v) * tiny and not turned:
            break
    for _ in range(2):  # close pairs turn by rounding, at second order off orthogonal
        x = x + x @ (np.eye(len(v), dtype=WIDE) - x.T @ x) / 2
    e = np.diag(x.T @ (v @ x)) * size
    order = np.argsort(-e, kind="stable")
    x, e = x[:, order], e[order]
    return e, x * np.where(x[np.abs(x).argmax(axis=0), np.arange(len(e))] < 0, -1, 1)


@dataclass
class Whitening:
    """Everything a task needs; its size is that of the dimension."""

    n: int
    sums: list[int]          # per dimension, exact
    centre: np.ndarray       # rounded means
    rest: list[int]          # sums - n * centre
    eigenvalues: np.ndarray  # all, falling
    vectors: np.ndarray      # (dimension, kept components)
    explained: np.ndarray    # share of each kept component in the trace
    scalable: np.ndarray     # kept components whose eigenvalue is above zero

    def whiten(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre).astype(np.float64) - np.array([s / self.n for s in self.rest])
        e = np.where(self.scalable, self.eigenvalues[:len(self.scalable)], 1.0)
        return (z @ self.vectors) / np.sqrt(e)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        z = x - self.centre
        top = self.n * int(np.abs(z).max(initial=0)) + max(map(abs, self.rest))
        if top * top * x.shape[1] < 1 << 63:
            return ((self.n * z - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        whole = ((self.n * z.astype(object) - np.array(self.rest, object)) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in whole]


def _vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    return df.select(F.col(id_col), F.col(vec_col).cast("array<double>").alias("_vector"))


def fit(df: DataFrame, components: int = 8, id_col: str = "vec_id",
        vec_col: str = "embedding") -> Whitening | None:
    """Mean and components of all usable vectors (None if there are none)."""
    vectors = _vectors(df, id_col, vec_col)
    sums = _sums(vectors).persist()
    try:
        most = sums.filter("i = -1").orderBy(F.col("v").desc(), F.col("dim").desc()).first()
        if most is None:
            return None
        by_dim = {r.i: int(r.v) for r in sums.filter(F.col("dim") == most.dim).collect()}
    finally:
        sums.unpersist()
    d, n = most.dim, by_dim.pop(-1)
    s = [by_dim[i] for i in range(d)]
    centre = [(2 * v + n) // (2 * n) for v in s]
    rest = [v - n * r for v, r in zip(s, centre)]
    centre = np.array(centre, np.int64)
    cov = np.zeros((d, d), WIDE)
    total = 0
    for r in _products(vectors, centre).collect():  # a row per pair of dimensions
        num = n * int(r.v) - rest[r.i] * rest[r.j]
        cov[r.i, r.j] = cov[r.j, r.i] = _ratio(num, n * n)
        total += num if r.i == r.j else 0
    e, x = refined_eigen(cov)
    k = min(components, d)
    trace = _ratio(total, n * n)
    e, x = e.astype(np.float64), x[:, :k].astype(np.float64)
    share = (e[:k] / float(trace)) if trace else np.zeros(k)
    return Whitening(n, s, centre, rest, e, x, share, e[:k] > float(trace) * d * np.finfo(np.float64).eps)


def identity_error(df: DataFrame, w: Whitening, id_col: str = "vec_id", vec_col: str = "embedding") -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the
    identity, from a pass over all vectors."""
    d, k = len(w.sums), len(w.scalable)
    box = df.sparkSession.sparkContext.broadcast(w)

    def run(batches):
        total = np.zeros((k + 1, k))
        for b in batches:
            for _, x in _matrices(b, d):
                y = box.value.whiten(x)
                total[:k] += y.T @ y
                total[k] += y.sum(axis=0)
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()),
                                          pa.array(total.ravel())], ["i", "j", "v"])

    rows = _vectors(df, id_col, vec_col).mapInArrow(run, "i int, j int, v double")
    total = np.zeros((k + 1, k))
    for r in rows.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[r.i, r.j] = r.v
    mean = total[k] / w.n
    off = np.abs(total[:k] / w.n - np.outer(mean, mean) - np.eye(k))[np.ix_(w.scalable, w.scalable)]
    return float(off.max()) if off.size else None


def whiten(df: DataFrame, components: int = 8, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row
    per usable vector and component."""
    schema = (f"`{id_col}` {dict(df.dtypes)[id_col]}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    w = fit(df, components, id_col, vec_col)
    if w is None:
        return df.sparkSession.createDataFrame([], schema)
    error = identity_error(df, w, id_col, vec_col)
    d, k = len(w.sums), len(w.scalable)
    box = df.sparkSession.sparkContext.broadcast(w)

    def run(batches):
        w = box.value
        for b in batches:
            for at, x in _matrices(b, d):
                m = len(at)
                y = np.ma.array(w.whiten(x), mask=np.tile(~w.scalable, (m, 1)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(np.repeat(at, k))),
                     pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                     pa.array(np.full(m * k, w.n), pa.int64()),
                     pa.array(w.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(y.data.ravel(), pa.float64(), mask=np.ma.getmaskarray(y).ravel()),
                     pa.array(np.tile(w.explained, m), pa.float64()),
                     pa.array([error] * (m * k), pa.float64())],
                    [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return _vectors(df, id_col, vec_col).mapInArrow(run, schema)
