"""Whitening against a direct eigendecomposition and exact integer sums."""

import numpy as np
import pytest

from tallyloom.llm import whitening as wh
from tallyloom.llm.catalog import QUERIES

from .conftest import CLASHES, SF


def whole(spark, x, parts=3):
    return spark.createDataFrame([(k, [int(c) for c in row]) for k, row in enumerate(x)], "vec_id long, x array<bigint>").repartition(parts)


def brute(x, components=8):
    """Eigenvalues, eigenvectors and trace of the covariance, divisor n, from the centred rows' singular values."""
    _, sizes, turned = np.linalg.svd(x - x.mean(0), full_matrices=False)
    values = sizes * sizes / len(x)
    return values[:components], turned[:components].T, values.sum()


def check(spark, x, components=8):
    frame = whole(spark, x)
    fit = wh.fit_whitening(frame, components=components)
    values, vectors, trace = brute(np.asarray(x, float), components)
    assert fit.n == len(x) and fit.sums == [int(s) for s in np.asarray(x, object).sum(0)]
    assert np.allclose(fit.values, values[:len(fit.values)], rtol=1e-7)
    assert fit.trace == pytest.approx(trace, rel=1e-12)
    assert np.abs(np.abs((fit.vectors * vectors[:, :len(fit.values)]).sum(0)) - 1).max() < 1e-9
    assert wh.identity_error(frame, fit) < 1e-10
    got = {r["vec_id"]: r for r in wh.whiten(frame, fit).collect()}
    n, s = len(x), np.asarray(x, object).sum(0)
    for k, row in enumerate(x):
        exact = sum((n * int(c) - int(t)) ** 2 for c, t in zip(row, s))
        assert got[k]["deviation"] == (exact if exact < 1 << 63 else None)
        want = ((np.asarray(row, float) - np.asarray(x, float).mean(0)) @ fit.vectors) / np.sqrt(fit.values)
        assert np.allclose(got[k]["whitened"], want, atol=1e-8)
    return fit


def test_falling_eigenvalues(spark):
    rng = np.random.default_rng(1)
    turned = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    check(spark, np.floor(rng.standard_normal((300, 12)) * 1000 * 0.7 ** np.arange(12) @ turned).astype(int) + 100000)


def test_wide_range_of_variances(spark):
    """Standard deviations from 1 to 1e7, the smallest ones kept: the squared condition number alone would lose them."""
    rng = np.random.default_rng(2)
    fit = check(spark, np.floor(rng.standard_normal((400, 8)) * 10.0 ** np.arange(8)).astype(int))
    assert len(fit.values) == 8


def test_dependent_and_constant_columns_have_no_component(spark):
    rng = np.random.default_rng(3)
    x = np.floor(rng.standard_normal((60, 5)) * 500).astype(int)
    x = np.hstack([x, x[:, :1] + x[:, 1:2], np.full((60, 1), 7)])
    assert len(check(spark, x).values) == 5
    assert len(check(spark, np.repeat(x[:2], 20, axis=0)).values) == 1
    assert len(check(spark, x[:3], components=2).values) == 2


def test_no_variance_and_no_rows(spark):
    fit = wh.fit_whitening(whole(spark, [[5, 6]] * 4))
    assert fit.n == 4 and len(fit.values) == 0
    assert [r["deviation"] for r in wh.whiten(whole(spark, [[5, 6]]), fit).collect()] == [0]
    assert wh.fit_whitening(whole(spark, [[1]]).where("false")) is None


def test_sums_beyond_64_bits_are_exact(spark):
    x = [[(1 << 45) + k, -k] for k in range(6)]
    fit = wh.fit_whitening(whole(spark, x))
    assert fit.sums == [6 * (1 << 45) + 15, -15]
    big = np.array([[1 << 45, 0]], np.int64)
    assert wh.centred(big, 1 << 30, [3, 0]).tolist() == [[(1 << 75) - 3, 0]]


def test_nulls_lengths_and_clashing_columns(spark):
    rows = [(1, [0.5, -0.25, 1.0]), (2, [0.1, 0.2, 0.3]), (2, [0.1, 0.2, 0.3]), (None, [-1.0, 0.0, 2.0]), (3, None), (4, [1.0, None, 0.0]),
            (5, [float("nan"), 0.0, 0.0]), (6, [float("inf"), 0.0, 0.0]), (7, []), (8, [1.0]), (9, [1e30, 0.0, 0.0])]
    names = [*CLASHES, "n", "x", "key", "v"]
    frame = spark.createDataFrame([r + ("x",) * len(names) for r in rows], "vec_id long, embedding array<double>, " + ", ".join(f"`{c}` string" for c in names))
    made = wh.quantised(frame)
    assert sorted(((r["vec_id"] or 0), r["x"]) for r in made.collect())[0] == (0, [98976, 100000, 102048])
    fit = wh.fit_whitening(made)
    got = wh.whiten(made, fit).collect()
    assert sorted(r["vec_id"] or 0 for r in got) == [0, 1, 2, 2]
    assert fit.n == 4 and len(fit.values) == 2


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = np.floor(1024 * np.array([r["embedding"] for r in rows], np.float64)).astype(np.int64) + 100000
    values, vectors, trace = brute(x.astype(float))
    ids = {r["vec_id"]: k for k, r in enumerate(rows)}
    got = QUERIES["op11_embedding_whitening"](spark, SF).collect()
    assert len(got) == 8 * len(rows)
    made = np.zeros((len(rows), 8))
    for r in got:
        made[ids[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["n"] == len(rows) and r["identity_error"] < 1e-10
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / trace, rel=1e-9)
    want = (x - x.mean(0)) @ vectors / np.sqrt(values)
    assert np.allclose(made, want * np.sign((made * want).sum(0)), atol=1e-6)
    assert np.abs(made.T @ made / len(rows) - np.eye(8)).max() < 1e-9
    exact = {i: sum((len(rows) * int(c) - int(s)) ** 2 for c, s in zip(x[k], x.sum(0))) for i, k in ids.items()}
    assert all(exact[r["vec_id"]] == r["deviation"] for r in got)
