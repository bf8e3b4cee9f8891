"""Whitening of embeddings onto the leading principal components.

Vectors become integers; each distinct one counts once. Count and sums are exact, the centred covariance is
summed from the tasks' partial products, and only that matrix (dimensions squared) reaches the driver. There it is
made tridiagonal by Householder reflections, its leading eigenvalues are found by bisection on Sturm counts, and
its eigenvectors by inverse iteration, orthogonalised again within clusters of close eigenvalues. The
components go out with the tasks that project the rows.

Left out are rows whose vector is NULL, empty, holds NULL or a non-finite entry, or has another number of entries
than most of the rows (of equally frequent numbers the least). Rows with the same vector, the same id or a NULL id are
rows of their own and come back as such. Without rows the result is empty. A component without
variance beyond rounding (a single distinct vector, fewer dimensions than components) has no rows, as nothing can be divided by
its deviation. ``deviation`` is NULL where it doesn't fit in a long. Columns beside the two that are named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.session import stage

COMPONENTS = 4
SCALE = 256
#: Eigenvalues closer than this share of the largest entry are one cluster.
CLOSE = 1e-3
_LONG = 2**63 - 1


# --- eigenvalues and eigenvectors of one small symmetric matrix ---


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal d, off-diagonal e, orthogonal q) with a = q T q', T built of d and e, by Householder reflections."""
    a = np.array(a, dtype=np.float64)
    n = len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1:, k]
        scale = np.abs(x).max()
        if scale == 0 or not np.any(x[1:]):
            continue
        v = x / scale
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        x_new = x - 2 * v * (v @ x)
        a[k + 1:, k] = a[k, k + 1:] = x_new
        a[k + 2:, k] = a[k, k + 2:] = 0.0
        q[:, k + 1:] -= 2 * np.outer(q[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def below(d: np.ndarray, e2: np.ndarray, at: float, least: float) -> int:
    """How many eigenvalues of the tridiagonal matrix lie below ``at``: negative pivots of its Sturm sequence."""
    count, pivot = 0, 1.0
    for i in range(len(d)):
        pivot = d[i] - at - (e2[i - 1] / pivot if i else 0.0)
        if abs(pivot) < least:
            pivot = -least
        count += pivot < 0
    return count


def leading_values(d: np.ndarray, e: np.ndarray, k: int) -> list[float]:
    """The ``k`` largest eigenvalues, largest first, each bisected until the bracket can't be halved any more."""
    n, e2 = len(d), e * e
    reach = np.abs(np.concatenate([[0.0], e])) + np.abs(np.concatenate([e, [0.0]]))
    low, high = float((d - reach).min()), float((d + reach).max())
    least = np.finfo(float).tiny / np.finfo(float).eps * max(1.0, float(e2.max(initial=0.0)))
    found: list[float] = []
    for j in range(min(k, n)):
        a, b = low, found[-1] if found else high + abs(high) * 1e-12 + 1e-300
        while True:
            mid = a + (b - a) / 2
            if not a < mid < b:
                break
            if below(d, e2, mid, least) >= n - j:
                b = mid
            else:
                a = mid
        found.append(b)
    return found


def solve_shifted(d: np.ndarray, e: np.ndarray, shift: float, rhs: np.ndarray, least: float) -> np.ndarray:
    """x with (T - shift) x = rhs, by elimination with row exchanges; vanishing pivots become ``least``."""
    n = len(d)
    main, upper, upper2 = d - shift, np.append(e, 0.0), np.zeros(n)
    x = rhs.copy()
    for i in range(n - 1):
        sub = e[i]
        if abs(sub) > abs(main[i]):  # the next row leads
            factor = main[i] / sub
            main[i], lead_next = sub, main[i + 1]
            main[i + 1] = upper[i] - factor * lead_next
            upper[i] = lead_next
            upper2[i], upper[i + 1] = upper[i + 1], -factor * upper[i + 1]
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            if abs(main[i]) < least:
                main[i] = least
            factor = sub / main[i]
            main[i + 1] -= factor * upper[i]
            x[i + 1] -= factor * x[i]
    if abs(main[-1]) < least:
        main[-1] = least
    for i in range(n - 1, -1, -1):
        x[i] = (x[i] - (upper[i] * x[i + 1] if i + 1 < n else 0.0)
                - (upper2[i] * x[i + 2] if i + 2 < n else 0.0)) / main[i]
    return x


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as rows."""
    n, size = len(a), float(np.abs(a).max())
    if size == 0:
        return np.zeros(min(k, n)), np.eye(n)[:k]
    d, e, q = tridiagonal(a)
    values = leading_values(d, e, k)
    least = np.finfo(float).eps * size
    vectors: list[np.ndarray] = []
    first = 0  # of the cluster that the vector at hand belongs to
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLOSE * size:
            first = j
        # equal shifts would give equal solutions; the start vectors differ and the cluster is kept orthogonal
        x = np.random.default_rng(j).normal(size=n)
        for _ in range(6):
            for _ in range(2):
                for other in vectors[first:]:
                    x -= (other @ x) * other
            x = solve_shifted(d, e, value, x / np.linalg.norm(x), least)
            x /= np.abs(x).max()
        for _ in range(2):
            for other in vectors[first:]:
                x -= (other @ x) * other
            x /= np.linalg.norm(x)
        vectors.append(x)
    out = np.array(vectors) @ q.T
    return np.array(values), out / np.linalg.norm(out, axis=1, keepdims=True)


# --- the distributed part ---


@dataclass(frozen=True)
class Whitener:
    """What was fitted: number of distinct vectors, exact sums, eigenvalues, components as rows, trace, error."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0


def integers(vector: Column) -> Column:
    """Entries as whole numbers of 1/256, rounded down."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))


def usable(rows: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, x) of the rows that have a whole finite vector of the usual length."""
    v = F.col(column)
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = rows.select(F.col(id_column).alias("vec_id"), F.when(fine, v).alias("v")).where("v IS NOT NULL")
    usual = whole.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    dims = usual[0].d if usual else 0
    return whole.where(F.size("v") == dims).select("vec_id", integers(F.col("v")).alias("x"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def _products(fit: DataFrame, centre, dims: int, of) -> np.ndarray:
    """Sum over all vectors of the outer product of ``of(x - centre)``, added up in the tasks, then by Spark."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            if batch.num_rows:
                y = of(_matrix(batch.column(0)).astype(np.float64) - centre)
                total += y.T @ y
        yield pa.record_batch([pa.array(range(dims), pa.int32()), pa.array(list(total))], names=["i", "part"])

    summed = (fit.mapInArrow(partial, "i int, part array<double>").select("i", F.posexplode("part").alias("j", "v"))
              .groupBy("i", "j").agg(F.sum("v").alias("v")))
    out = np.zeros((dims, dims))
    for r in summed.collect():  # dims * dims numbers
        out[r.i, r.j] = r.v
    return (out + out.T) / 2


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Fitted on each distinct ``x`` once, in three passes over them; None without vectors."""
    distinct = stage(vectors.select("x").distinct(), "distinct-vectors")
    totals = (distinct.select(F.posexplode("x").alias("i", "v"))
              .groupBy("i").agg(F.sum("v").alias("s"), F.count("*").alias("n")).orderBy("i").collect())
    if not totals:
        return None
    n, sums, dims = totals[0].n, tuple(r.s for r in totals), len(totals)
    mean = np.array([s / n for s in sums])
    covariance = _products(distinct, mean, dims, lambda y: y) / n
    trace = float(np.trace(covariance))
    values, vectors_ = leading(covariance, components)
    live = values > max(trace, 0.0) * dims * np.finfo(float).eps
    values, vectors_ = values[live], vectors_[live]
    error = 0.0
    if len(values):
        deviation = np.sqrt(values)
        white = _products(distinct, mean, len(values), lambda y: y @ vectors_.T / deviation) / n
        error = float(np.abs(white - np.eye(len(values))).max())
    return Whitener(n, sums, values, vectors_, trace, error)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact sum over dimensions of (n * x - S)^2 for each row; None beyond a long."""
    if not len(x):
        return []
    reach = n * max(abs(int(x.max())), abs(int(x.min()))) + max(abs(int(s)) for s in sums)
    if reach * reach * x.shape[1] <= _LONG:
        y = n * x - np.array([int(s) for s in sums], dtype=np.int64)
        return (y * y).sum(axis=1).tolist()
    exact = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]
    return [e if e <= _LONG else None for e in exact]


SCHEMA = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
          "identity_error double")


def project(vectors: DataFrame, model: Whitener | None) -> DataFrame:
    """A row for each of (vec_id, x) and each component."""
    if model is None:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    k = len(model.values)
    mean, scale = np.array([s / model.n for s in model.sums]), np.sqrt(model.values)
    explained = model.values / model.trace if k else model.values

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m or not k:
                continue
            x = _matrix(batch.column(1)).astype(np.int64)
            white = (x - mean) @ model.components.T / scale
            at = np.repeat(np.arange(m), k)
            yield pa.record_batch([
                batch.column(0).cast(pa.int64()).take(pa.array(at)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n, dtype=np.int64)),
                pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(at)),
                pa.array(white.ravel()), pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, model.identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(rows, SCHEMA)


def whiten(rows: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id",
           column: str = "embedding") -> DataFrame:
    """Rows projected on the leading components of all distinct vectors and divided by their deviation."""
    vectors = usable(rows, id_column, column)
    return project(vectors, fit(vectors, components))
