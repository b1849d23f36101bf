"""Embedding whitening by Jacobi-Davidson on a matrix-free covariance.

The covariance is never formed. Spark centres the vectors of the fit list and
multiplies it with a few columns in one distributed pass, y = sum of
(x - mean) ((x - mean) . v) / n, and adds the tasks' shares. On the driver, which
only holds columns as long as one vector, Rayleigh-Ritz on a small subspace
gives approximate eigenvectors; each outer step solves the projected correction
equations of those not yet exact by a few steps of MINRES, all of them in the
same distributed passes, and adds the solutions to the subspace. Eigenvectors
whose residual reaches double precision are locked, the largest first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

COMPONENTS = 4
#: Columns that the subspace may have beyond which it is restarted, and with how many.
MOST, KEPT = 64, 24
#: Steps of MINRES for a correction at most, and outer steps at most.
INNER, OUTER = 4, 100
EPS = float(np.finfo(np.float64).eps)
#: Vectors of a packed block.
PACKED = 4096
#: Components of less than this share of the trace have no variance that double precision can tell from none.
FLAT = 1e-12

Product = Callable[[np.ndarray], np.ndarray]


def usable(vector: Column) -> Column:
    """Vectors that are not null and hold neither null nor non-finite entries."""
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def minres(product: Product, b: np.ndarray, steps: int, reach: float) -> np.ndarray:
    """MINRES of Paige and Saunders for each column of b, all columns in the
    same products; ends when every residual is `reach` of its column."""
    x = np.zeros_like(b)
    beta = np.linalg.norm(b, axis=0)
    first = np.where(beta > 0, beta, 1.0)
    live = beta > 0
    old, v = np.zeros_like(b), b / first
    d_old, d = np.zeros_like(b), np.zeros_like(b)
    c_old, c, s_old, s = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    eta, below = beta.copy(), np.zeros_like(beta)
    for _ in range(steps):
        av = product(v)
        alpha = (v * av).sum(axis=0)
        after = av - alpha * v - below * old
        beta = np.linalg.norm(after, axis=0)
        # the new column of the tridiagonal matrix, turned by the last two rotations
        r3 = s_old * below
        r2 = s * alpha + c * c_old * below
        r1 = c * alpha - s * c_old * below
        norm = np.hypot(r1, beta)
        live &= norm > 0
        safe = np.where(norm > 0, norm, 1.0)
        c_old, s_old, c, s = c, s, np.where(norm > 0, r1 / safe, 1.0), beta / safe
        new = (v - r3 * d_old - r2 * d) / safe
        x += np.where(live, c * eta * new, 0.0)
        eta = -s * eta
        d_old, d = d, new
        live &= beta > EPS * first
        if not (live & (np.abs(eta) > reach * first)).any():
            break
        old, v, below = v, after / np.where(beta > 0, beta, 1.0), beta
    return x


def _orthonormal(new: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Columns of `new` made orthonormal to the basis and one another; those
    that the others already span are left out."""
    out = basis
    for j in range(new.shape[1]):
        t, size = new[:, j], np.linalg.norm(new[:, j])
        if not size > 0 or not np.isfinite(size):
            continue
        t = t / size
        for _ in range(3):
            t = t - out @ (out.T @ t)
            left = np.linalg.norm(t)
            if left < 1e-8:
                break
            t = t / left
        if left >= 1e-8:
            out = np.concatenate([out, t[:, None]], axis=1)
    return out[:, basis.shape[1]:]


def jacobi_davidson(product: Product, size: int, want: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues falling, eigenvectors as columns, largest residual over the
    first eigenvalue) of the `want` largest eigenpairs of a symmetric operator
    without negative eigenvalues."""
    want = min(want, size)
    rng = np.random.default_rng(seed)
    locked, values = np.zeros((size, 0)), []
    v = _orthonormal(rng.normal(size=(size, min(size, want + 2))), locked)
    av = product(v)
    scale = worst = 0.0
    for outer in range(OUTER):
        h = v.T @ av
        theta, turn = np.linalg.eigh((h + h.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        v, av = v @ turn, av @ turn
        scale = max(scale, abs(theta[0]) if len(theta) else 0.0)
        rest = min(want - len(values), v.shape[1])
        r = av[:, :rest] - v[:, :rest] * theta[:rest]
        r -= locked @ (locked.T @ r)
        far = np.linalg.norm(r, axis=0)
        whole = v.shape[1] + len(values) >= size  # the subspace is all there is
        n = 0
        while n < rest and (far[n] <= 2 * size * EPS * scale or whole):
            n += 1
        if n:
            worst = max(worst, float(far[:n].max()))
            locked, values = np.concatenate([locked, v[:, :n]], axis=1), [*values, *theta[:n]]
            v, av, r, theta, far = v[:, n:], av[:, n:], r[:, n:], theta[n:], far[n:]
        if len(values) == want:
            break
        rest -= n
        if not rest:
            v = _orthonormal(rng.normal(size=(size, want - len(values))), locked)
            av = product(v)
            continue
        near = np.concatenate([locked, v[:, :rest]], axis=1)

        def projected(t: np.ndarray) -> np.ndarray:
            t = t - near @ (near.T @ t)
            y = product(t) - t * theta[:rest]
            return y - near @ (near.T @ y)

        t = minres(projected, -(r[:, :rest] - near @ (near.T @ r[:, :rest])), INNER, 2.0 ** -(outer + 2))
        if v.shape[1] + rest > MOST:
            v, av = v[:, :KEPT], av[:, :KEPT]
        basis = np.concatenate([locked, v], axis=1)
        new = _orthonormal(t, basis)
        if not new.shape[1]:  # the corrections are in the subspace already
            new = _orthonormal(rng.normal(size=(size, 1)), basis)
        v, av = np.concatenate([v, new], axis=1), np.concatenate([av, product(new)], axis=1)
    else:  # never reached double precision: the best there is, with its residual
        worst = max(worst, float(far.max(initial=0.0)))
        n = want - len(values)
        locked, values = np.concatenate([locked, v[:, :n]], axis=1), [*values, *theta[:n]]
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], locked[:, order], worst / scale if scale else 0.0


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _blocks(fit: DataFrame) -> DataFrame:
    """(dims, width, block): vectors of `dims` entries packed as little-endian
    integers of `width` bytes, a batch a row, since every product reads them all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            out = []
            for dims in np.unique(sizes):
                x = _matrix(batch.column(0).filter(pa.array(sizes == dims)))
                for at in range(0, len(x), PACKED):
                    some = x[at:at + PACKED]
                    width = next((w for w in (2, 4) if -(1 << 8 * w - 1) <= some.min() and some.max() < 1 << 8 * w - 1), 8)
                    out.append((int(dims), width, some.astype(f"<i{width}").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32()),
                                              pa.array([o[2] for o in out], pa.binary())], names=["dims", "width", "block"])

    return fit.select("x", F.size("x").alias("dims")).mapInArrow(run, "dims int, width int, block binary")


def _summed(blocks: DataFrame, share: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all vectors of what `share` makes of a block of them:
    `size` numbers, added in each task and then on Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for dims, width, block in zip(*(batch.column(i) for i in range(3))):
                x = np.frombuffer(block.as_buffer(), dtype=f"<i{width.as_py()}").reshape(-1, dims.as_py())
                total += share(x.astype(np.float64))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], names=["at", "value"])

    out = np.zeros(size)
    for r in blocks.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect():
        out[r["at"]] = r["value"]
    return out


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n x - S)^2 of each row, exact; None where 64 bits do not hold it."""
    most = n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, sums))
    if most * most * x.shape[1] < 1 << 63:
        return ((x * n - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = 256, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error,
    residual) of each usable row and component.

    Rows whose vector is null or holds a null or non-finite entry are left
    out; entries become floor(scale * c), held within 64 bits. The fit list
    holds each distinct vector once. Repeated rows, rows with equal or null ids
    and vectors that occur on many rows all keep their rows. Vectors of
    different lengths are fitted apart. There are as many components as the
    vectors have entries and variance, `components` at most: one distinct vector,
    vectors without entries and empty tables give no rows. `deviation` is null
    where it exceeds 64 bits. `residual` is the largest residual of an
    eigenvector over the largest eigenvalue. Other columns are not read.
    """
    kind = vectors.schema[id_col].dataType
    rows = vectors.where(usable(F.col(vector_col))).select(
        F.col(id_col).alias("id"), F.transform(vector_col, lambda c: F.floor(c.cast("double") * scale)).alias("x"))
    rows = stored(rows, "whitening-rows")
    fit_all = stored(rows.select("x").where(F.size("x") > 0).distinct(), "whitening-fit")
    sums = (fit_all.select(F.size("x").alias("dims"), F.posexplode("x")).groupBy("dims", "pos")
            .agg(F.count("*").alias("n"), F.sum(F.col("col").cast("decimal(20,0)")).alias("s")).collect())
    blocks = stored(_blocks(fit_all), "whitening-blocks")
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("component", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
                           *(T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error", "residual"))])
    done = [_whitened(rows, blocks, dims, [r for r in sums if r.dims == dims], components, schema)
            for dims in sorted({r.dims for r in sums})]
    out = vectors.sparkSession.createDataFrame([], schema)
    for part in done:
        out = out.unionByName(part)
    return out


def _whitened(rows: DataFrame, blocks: DataFrame, dims: int, sums: list, components: int, schema: T.StructType) -> DataFrame:
    n, total = int(sums[0].n), [int(r.s) for r in sorted(sums, key=lambda r: r.pos)]
    mean = np.array([s / n for s in total])
    fit = blocks.where(F.col("dims") == dims)
    trace = float(_summed(fit, lambda x: np.array([((x - mean) ** 2).sum()]), 1)[0]) / n

    def product(v: np.ndarray) -> np.ndarray:
        def share(x: np.ndarray) -> np.ndarray:
            x = x - mean
            return (x.T @ (x @ v)).ravel()
        return _summed(fit, share, v.size).reshape(v.shape) / n

    if trace > 0:
        values, u, residual = jacobi_davidson(product, dims, components)
        some = values > FLAT * trace
        values, u = values[some], u[:, some]
    else:
        values, u, residual = np.zeros(0), np.zeros((dims, 0)), 0.0
    k = len(values)
    axes = u / np.sqrt(values)
    error = 0.0
    if k:
        def moments(x: np.ndarray) -> np.ndarray:
            w = (x - mean) @ axes
            return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        got = _summed(fit, moments, k + k * k) / n
        error = float(np.abs(got[k:].reshape(k, k) - np.outer(got[:k], got[:k]) - np.eye(k)).max())
    explained = values / trace if k else values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, m = _matrix(batch.column(1)), len(batch)
            if not m or not k:
                continue
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                pa.array(np.full(m * k, n), pa.int64()),
                pa.array(_deviation(x, n, total), pa.int64()).take(pa.array(each)),
                pa.array(((x - mean) @ axes).ravel()), pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, error)), pa.array(np.full(m * k, residual))], names=schema.names)

    return rows.where(F.size("x") == dims).mapInArrow(run, schema)
