"""Embedding whitening by eigenvalue slices of the covariance (FEAST).

The covariance of the fit list is summed over all vectors on Spark: integer
sums first, then products of centred entries, one partial matrix a task, added
up cell by cell.  Only that dims x dims matrix, whose size does not depend on
the rows, reaches the driver.  There inertia counts cut the upper spectrum into
intervals; every interval is one Spark task, which projects a random block onto
the interval by quadrature of complex shifted solves around a contour, extracts
components by Rayleigh-Ritz, repeats until the residuals are at rounding, and
compares their number with the inertia count, so that none is missed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000  # an entry c becomes floor(SCALE * c) + SHIFT
LARGEST = 2.0 ** 52  # entries beyond +-LARGEST / SCALE count as that
FITS = 9.0e18  # a deviation beyond this is null: it does not fit a long
AN_INTERVAL = 8  # components an interval is cut for
NODES = 12  # quadrature nodes on the upper half of a contour
ROUNDS = 60  # of one interval, before it is given up with an error
CELLS = 1 << 20  # entries held at once in a task


# ------------------------------------------------------------ dense algebra

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix congruent (by
    reflections) to the symmetric `a`."""
    a = np.array(a, dtype=float)
    for k in range(len(a) - 2):
        x = a[k + 1:, k].copy()
        alpha = -np.copysign(np.linalg.norm(x), x[0])
        if alpha == 0:
            continue
        x[0] -= alpha
        v = x / np.linalg.norm(x)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        q = p - (v @ p) * v
        rest -= 2 * (np.outer(v, q) + np.outer(q, v))
        a[k + 1, k] = alpha
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(t: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """How many eigenvalues exceed `shift`: the positive pivots of T - shift I
    (Sylvester's law of inertia)."""
    diagonal, squares = t[0].tolist(), (t[1] ** 2).tolist()
    tiny = np.finfo(float).tiny
    pivot = diagonal[0] - shift
    n = int(pivot > 0)
    for d, s in zip(diagonal[1:], squares):
        pivot = d - shift - s / (pivot or tiny)
        n += int(pivot > 0)
    return n


def _nth(t, n: int, low: float, high: float) -> float:
    """The n-th largest eigenvalue by bisection on the counts."""
    for _ in range(64):
        mid = (low + high) / 2
        if count_above(t, mid) >= n:
            low = mid
        else:
            high = mid
    return (low + high) / 2


def intervals(cov: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """(low, high, count) of intervals that together hold the `k` largest
    eigenvalues and no other half of a cluster.  Eigenvalues at rounding
    distance from zero are left out."""
    t = tridiagonal(cov)
    radius = np.abs(t[0]) + np.append(np.abs(t[1]), 0) + np.append(0, np.abs(t[1]))
    top = float(radius.max())
    floor = len(cov) * np.finfo(float).eps * top * 8
    rank = count_above(t, floor)
    out, done, high = [], 0, top * (1 + 1e-9)
    while done < min(k, rank):
        last = min(done + AN_INTERVAL, k, rank)
        here = _nth(t, last, -top, high)
        while True:  # a boundary goes into a gap, not through a cluster
            below = _nth(t, last + 1, -top, high) if last < rank else 0.0
            if last == rank or here - below > 1e-9 * top:
                break
            last, here = last + 1, below
        low = max((here + below) / 2, floor)
        out.append((float(low), float(high), last - done))
        done, high = last, low
    return out


def feast(cov: np.ndarray, low: float, high: float, count: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The `count` eigenpairs of `cov` inside (low, high), values falling.

    Raises if Rayleigh-Ritz does not find as many as the inertia count says."""
    d = len(cov)
    scale = float(np.abs(cov).sum(axis=1).max())
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(0.5j * np.pi * (nodes + 1))
    middle, radius = (low + high) / 2, (high - low) / 2
    solves = [np.linalg.inv((middle + radius * z) * np.eye(d) - cov) for z in turns] if d <= 512 else None
    m = min(d, 2 * count + 4)
    block = np.random.default_rng(seed).standard_normal((d, m))
    best = np.inf
    for _ in range(ROUNDS):
        projected = np.zeros_like(block)
        for j, (z, w) in enumerate(zip(turns, weights)):
            x = solves[j] @ block if solves else np.linalg.solve((middle + radius * z) * np.eye(d) - cov, block)
            projected += 0.5 * w * (radius * z * x).real
        q, _ = np.linalg.qr(projected)
        values, small = np.linalg.eigh(q.T @ cov @ q)
        block = q @ small
        inside = (values > low) & (values < high)
        worst = np.abs(cov @ block - block * values)[:, inside].max(initial=0.0)
        if inside.sum() == count and (worst <= 1e-15 * scale or worst <= 1e-11 * scale and worst >= best / 2):
            order = np.flatnonzero(inside)[::-1]
            return values[order], block[:, order]
        best = min(best, worst) if inside.sum() == count else np.inf
    raise RuntimeError(f"{int(inside.sum())} components between {low:g} and {high:g}, the inertia count is {count}; residual {worst:g}")


def refined(cov: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One Rayleigh-Ritz step over all intervals: orthogonal across them, too;
    the largest entry of a component is positive."""
    q, _ = np.linalg.qr(vectors)
    values, small = np.linalg.eigh(q.T @ cov @ q)
    vectors = (q @ small)[:, ::-1]
    at = np.abs(vectors).argmax(axis=0)
    return values[::-1], vectors * np.sign(vectors[at, np.arange(vectors.shape[1])])


# -------------------------------------------------------------- over vectors

def _entries(batch: pa.RecordBatch, dims: int):
    """(rows, entries floor(SCALE * c) as whole doubles) of slices of a batch."""
    step = max(1, CELLS // dims)
    for start in range(0, batch.num_rows, step):
        part = batch.slice(start, step)
        flat = part.column("v").flatten().to_numpy(zero_copy_only=False).astype(float)
        yield part, np.clip(np.floor(SCALE * flat), -LARGEST, LARGEST).reshape(-1, dims)


def _cells(vectors: DataFrame, dims: int, matrix, width: int) -> np.ndarray:
    """Sum over all vectors of `matrix(entries)` (2-d, `width` columns): one
    partial a task, added up cell by cell."""
    def partial(batches):
        total = 0.0
        for b in batches:
            for _, y in _entries(b, dims):
                total = total + matrix(y)
        if np.ndim(total):
            at = np.arange(total.size)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], ["cell", "value"])

    sums = vectors.select("v").mapInArrow(partial, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    rows = sums.collect()  # dims x dims cells at most, whatever the rows
    out = np.zeros(len(rows))
    for cell, value in rows:
        out[cell] = value
    return out.reshape(-1, width)


def fit_list(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows whose vector is not null and holds only finite
    entries; `v` as doubles."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embeddings.select(F.col(id_col).alias("vec_id"), v.alias("v"), (v.isNotNull() & (F.size(v) > 0) & finite).alias("ok")).where("ok").drop("ok")


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per remaining vector and component: vec_id, component (from 1, by
    falling eigenvalue), n, deviation, whitened, explained, identity_error.

    Null vectors and vectors with null or non-finite entries are dropped; so are
    empty ones and those whose length is not the commonest (ties: the longer).
    A null vec_id is kept; rows that repeat count as often as they stand.
    Components whose eigenvalue is zero to rounding cannot be whitened and are
    left out, so equal vectors, a single one or an empty table give no rows.  A
    deviation that does not fit a long is null.  Only the two columns are read.
    """
    spark = embeddings.sparkSession
    schema = T.StructType([T.StructField("vec_id", embeddings.schema[id_col].dataType), T.StructField("component", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType())])
    vectors = fit_list(embeddings, id_col, vector_col)
    sizes = vectors.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    nothing = spark.createDataFrame([], schema).withColumn("identity_error", F.lit(0.0))
    if not sizes:
        return nothing
    dims, n = sizes[0]
    vectors = vectors.where(F.size("v") == dims)
    sums = _cells(vectors, dims, lambda y: y.sum(axis=0, keepdims=True), dims)[0]
    mean = sums / n
    centred = lambda y: y - mean
    cov = _cells(vectors, dims, lambda y: centred(y).T @ centred(y), dims) / n
    cov = (cov + cov.T) / 2
    slices = intervals(cov, min(components, dims)) if cov.any() else []
    if not slices:
        return nothing
    shared = spark.sparkContext.broadcast(cov)  # dims x dims

    def solve(batches):
        for b in batches:
            for low, high, count in zip(*(b.column(c).to_pylist() for c in ("low", "high", "count"))):
                _, found = feast(shared.value, low, high, count)
                yield pa.RecordBatch.from_pydict({"low": [low] * count, "vector": found.T.tolist()})

    tasks = spark.createDataFrame(slices, "low double, high double, count int").repartition(len(slices), "low")
    found = sorted(tasks.mapInArrow(solve, "low double, vector array<double>").collect(), key=lambda r: -r["low"])
    values, axes = refined(cov, np.array([r["vector"] for r in found]).T)
    k = min(components, len(values))
    values, axes = values[:k], axes[:, :k]
    weights = axes / np.sqrt(values)
    explained = values / np.trace(cov)
    whole = np.array([int(s) for s in sums])

    def second_moments(y):
        w = centred(y) @ weights
        return np.vstack([w.T @ w, w.sum(axis=0, keepdims=True)])

    moments = _cells(vectors, dims, second_moments, k) / n
    error = float(np.abs(moments[:k] - np.outer(moments[k], moments[k]) - np.eye(k)).max())

    def project(batches):
        for b in batches:
            for part, y in _entries(b, dims):
                w = centred(y) @ weights
                about = ((n * y - sums) ** 2).sum(axis=1)
                fits = (about < FITS) & (np.abs(y).max(axis=1) * n < FITS)
                exact = np.zeros(len(y), dtype=np.int64)
                exact[fits] = ((n * y[fits].astype(np.int64) - whole) ** 2).sum(axis=1)
                rows = np.repeat(np.arange(len(y)), k)
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id").take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))),
                    pa.array(np.full(len(rows), n, dtype=np.int64)), pa.array(exact[rows], mask=~fits[rows]),
                    pa.array(w.ravel()), pa.array(np.tile(explained, len(y)))], schema.fieldNames())

    return vectors.mapInArrow(project, schema).withColumn("identity_error", F.lit(error))
