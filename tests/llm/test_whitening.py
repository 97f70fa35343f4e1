from __future__ import annotations

import math

import numpy as np
import pytest

from tempora.llm.eigen import leading_eigenpairs, leading_values, tridiagonalise
from tempora.llm.queries import op11_embedding_whitening
from tempora.llm.whitening import _deviation, whiten_embeddings

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, components=16):
    """The contract, step by step, with numpy's own eigenvalues."""
    sound = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = {k: np.array([math.floor(64 * c) + 1000000 for c in v], dtype=object) for k, (_, v) in enumerate(sound)}
    fit = [np.array(t, dtype=object) for t in sorted({tuple(v) for v in x.values()})]
    n, total = len(fit), sum(fit)
    centred = np.array([[float(n * int(a) - int(s)) / n for a, s in zip(v, total)] for v in fit])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:components]
    out = []
    for k, (i, _) in enumerate(sound):
        dev = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[k], total))
        z = np.array([float(n * int(a) - int(s)) / n for a, s in zip(x[k], total)])
        out.append((i, n, dev, (z @ vectors[:, order]) / np.sqrt(values[order])))
    return out, values[order] / np.trace(cov)


def check(got, rows, components=16):
    want, explained = plain(rows, components)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    k = len(explained)
    assert len(got) == len(want) * k
    signs = None
    for i, n, dev, white in want:
        mine = sorted(by[i], key=lambda r: r.component)[:: max(1, len(by[i]) // k)]
        assert [r.component for r in mine] == list(range(1, k + 1))
        assert {(r.n, r.deviation) for r in by[i]} == {(n, dev)}
        signs = signs if signs is not None else np.sign([r.whitened * w for r, w in zip(mine, white)])
        assert np.abs(np.array([r.whitened for r in mine]) - signs * white).max() < 1e-7
        assert np.allclose([r.explained for r in mine], explained, rtol=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-8


def test_eigenpairs_equal_numpy():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 7, 64):
        a = rng.normal(size=(n, n))
        a = a @ a.T
        values, vectors = leading_eigenpairs(a, 16)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:16], rtol=1e-12, atol=1e-12 * np.abs(a).max())
        assert np.allclose(a @ vectors, vectors * values, atol=1e-12 * max(1.0, values[0]))
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13)


def test_clusters_and_equal_eigenvalues_give_orthogonal_vectors():
    rng = np.random.default_rng(4)
    q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    for spectrum in (np.ones(40), np.r_[np.full(20, 5.0), np.full(20, 1.0)], 1 + 1e-12 * np.arange(40), np.r_[3.0, np.zeros(39)]):
        a = (q * spectrum) @ q.T
        a = (a + a.T) / 2
        values, vectors = leading_eigenpairs(a, 16)
        assert np.allclose(values, np.sort(spectrum)[::-1][:16], atol=1e-12)
        assert np.allclose(vectors.T @ vectors, np.eye(16), atol=1e-12)
        assert np.abs(a @ vectors - vectors * values).max() < 1e-12
    values, vectors = leading_eigenpairs(np.diag(np.arange(8.0)), 3)  # nothing to reflect
    assert np.allclose(values, [7, 6, 5]) and np.allclose(np.abs(vectors[[7, 6, 5], [0, 1, 2]]), 1)
    assert leading_eigenpairs(np.zeros((4, 4)), 2)[0].tolist() == [0, 0] and leading_eigenpairs(np.zeros((0, 0)), 2)[0].size == 0


def test_tridiagonal_form_keeps_the_spectrum():
    a = np.random.default_rng(5).normal(size=(20, 20))
    a = a + a.T
    d, e, _ = tridiagonalise(a)
    t = np.diag(d) + np.diag(e, 1) + np.diag(e, -1)
    assert np.allclose(np.linalg.eigvalsh(t), np.linalg.eigvalsh(a))
    assert np.allclose(leading_values(d, e, 20), np.linalg.eigvalsh(a)[::-1])


@pytest.mark.parametrize("dim", [20, 5])
def test_equals_the_contract(spark, dim):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, dim)) * rng.uniform(0.2, 3, dim) + rng.uniform(-9, 9, dim)
    x[100:200] = x[100]  # copies: a third of all rows
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(1000, None), (1001, [float("nan")] + [0.0] * (dim - 1)), (1002, [float("inf")] * dim), (1003, [None] + [1.0] * (dim - 1)), (1004, [])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + bad], SCHEMA).repartition(7)
    got = whiten_embeddings(df.selectExpr("*", "1 AS n", "'a' AS dim", "2 AS x")).collect()
    check(got, rows)


def test_odd_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert whiten_embeddings(none).count() == 0 and len(whiten_embeddings(none).columns) == 7
    one = whiten_embeddings(spark.createDataFrame([(1, [0.5, 0.25], 0), (None, [0.5, 0.25], 0)], SCHEMA)).collect()
    assert len(one) == 4 and {(r.n, r.deviation, r.whitened, r.explained) for r in one} == {(1, 0, None, 0.0)}
    # zero vectors take part, a constant dimension has no variance, lengths do not mix
    rows = [(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [2.0, 1.0]), (4, [2.0, 1.0])]
    got = whiten_embeddings(spark.createDataFrame([(i, v, 0) for i, v in rows + [(9, [1.0, 2.0, 3.0])]], SCHEMA)).collect()
    first = {r.vec_id: r for r in got if r.component == 1}
    assert [round(abs(first[i].whitened), 9) for i in (1, 2, 3, 4)] == [round(math.sqrt(1.5), 9), 0.0] + [round(math.sqrt(1.5), 9)] * 2
    assert first[1].explained == 1.0 and first[1].n == 3 and first[9].n == 1 and sum(r.vec_id == 9 for r in got) == 3
    assert all(r.whitened is None and r.explained == 0.0 for r in got if r.component == 2)
    huge = whiten_embeddings(spark.createDataFrame([(1, [1e300, 0.0], 0), (2, [-1e300, 1.0], 0)], SCHEMA)).collect()
    assert len(huge) == 4 and all(r.deviation is None for r in huge)


def test_deviation_is_exact_beyond_doubles():
    y, n, rest = np.array([[3_000_000_000, -7]]), 1, np.array([1, 0], dtype=object)
    assert _deviation(y, n, rest) == [2_999_999_999**2 + 49]
    assert _deviation(y * 2, n, rest) == [None]


def test_query_on_the_test_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(op11_embedding_whitening(spark, sf).collect(), rows)
