"""Whitening against numpy's own eigenvalues and exact whole-number arithmetic."""

import math

import numpy as np
import pytest

from panelforge.llm import whitening as W
from panelforge.llm.queries import QUERIES


@pytest.mark.parametrize("n", [1, 2, 3, 8, 40])
@pytest.mark.parametrize("kind", ["random", "close", "equal", "diagonal"])
def test_leading_eigenpairs(n, kind):
    rng = np.random.default_rng(n)
    q = np.linalg.qr(rng.normal(size=(n, n)))[0]
    values = {"random": rng.uniform(0, 9, n), "close": 5 + np.arange(n) * 1e-9, "equal": np.full(n, 3.0),
              "diagonal": np.arange(n) + 1.0}[kind]
    a = np.diag(values) if kind == "diagonal" else q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    d, e, o = W.tridiagonal(a)
    t = np.diag(d) + np.diag(e, 1) + np.diag(e, -1)
    assert np.allclose(o @ t @ o.T, a, atol=1e-12 * max(1, np.abs(a).max())) and np.allclose(o.T @ o, np.eye(n))
    k = min(4, n)
    got, vectors = W.leading(a, 4)
    assert np.allclose(got, np.linalg.eigvalsh(a)[::-1][:k], rtol=1e-12, atol=1e-12)
    assert np.allclose(vectors @ vectors.T, np.eye(k), atol=1e-10)
    assert np.allclose(a @ vectors.T, vectors.T * got, atol=1e-9)


def expected(vectors, components=4):
    whole = [np.floor(256 * np.asarray(v, dtype=np.float32).astype(float)).astype(int) for v in vectors]
    distinct = np.array(sorted({tuple(v) for v in whole}))
    n, s = len(distinct), distinct.sum(axis=0)
    cov = (distinct - s / n).T @ (distinct - s / n) / n
    values, columns = np.linalg.eigh(cov)
    values, columns = values[::-1][:components], columns[:, ::-1][:, :components]
    return whole, n, s, cov, values, columns


def test_rows_against_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = [rng.normal(size=6) * np.array([5, 3, 2, 1, .5, .2]) for _ in range(300)]
    vectors += vectors[:40]  # copies count once
    rows = [(i, [float(np.float32(c)) for c in v], "own") for i, v in enumerate(vectors)]
    odd = [(900, None, "x"), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0], "x"), (902, [math.nan] * 6, "x"),
           (903, [math.inf] + [0.0] * 5, "x"), (904, [1.0, 2.0], "x"), (905, [], "x")]
    again = [(0, rows[1][1], "y"), (None, rows[2][1], "z")]  # an id twice and no id: rows of their own
    df = spark.createDataFrame(rows + odd + again, "vec_id bigint, embedding array<float>, n string").repartition(7)
    out = W.whiten(df).collect()
    assert len(out) == 4 * (len(rows) + len(again))
    whole, n, s, cov, values, columns = expected([r[1] for r in rows])
    by = {}
    for r in out:
        by.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    assert {r.n for r in out} == {n} and max(r.identity_error for r in out) < 1e-9
    assert len({r.identity_error for r in out}) == 1
    sign = None
    for i, x in enumerate(whole):
        deviation = int(((n * x - s) ** 2).sum())
        got = by[i, deviation]
        assert sorted(got) == [1, 2, 3, 4]
        want = (x - s / n) @ columns / np.sqrt(values)
        mine = np.array([got[c].whitened for c in (1, 2, 3, 4)])
        sign = np.sign(mine * want) if sign is None else sign
        assert np.allclose(mine, want * sign, atol=1e-8)
        assert np.allclose([got[c].explained for c in (1, 2, 3, 4)], values / np.trace(cov), rtol=1e-9)


def test_awkward_tables(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert W.whiten(spark.createDataFrame([], schema)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, None)], schema)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, schema)).count() == 0  # no variance, no component
    two = W.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0])], schema)).collect()
    assert {(r.vec_id, r.component, abs(round(r.whitened, 9))) for r in two} == {(1, 1, 1.0), (2, 1, 1.0)}
    assert {r.explained for r in two} == {1.0}


def test_deviation_is_exact_beyond_doubles_and_null_beyond_longs():
    x = np.array([[3_000_000_001, 1], [-7, 2]])
    sums = (11, 5)
    want = [sum((3 * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    assert W.deviations(x, 3, sums) == [None if v > 2**63 - 1 else v for v in want]
    assert W.deviations(x[1:], 3, sums) == want[1:]


def test_query(spark, small_dir):
    out = QUERIES["op11_embedding_whitening"](spark, small_dir).toPandas()
    n = spark.read.parquet(f"{small_dir}/embeddings.parquet").count()
    assert len(out) == 4 * n and out.identity_error.max() < 1e-9
    assert np.allclose(out.groupby("component").whitened.apply(lambda w: (w ** 2).mean()), 1, atol=0.1)
