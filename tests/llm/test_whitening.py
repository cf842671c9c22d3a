"""Whitening against numpy's eigenvectors and exact small cases."""

from fractions import Fraction

import numpy as np
import pytest

from chirp.llm import queries as LQ
from chirp.llm import whitening as W
from tests.conftest import SF_ORACLE


def plain(vectors, k=16):
    x = np.floor(64 * np.array(vectors, float)) + 1_000_000
    fit = np.unique(x, axis=0)
    c = fit - fit.mean(axis=0)
    e, v = np.linalg.eigh(c.T @ c / len(fit))
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return x, fit, e, (x - fit.mean(axis=0)) @ v / np.sqrt(e)


def test_query_against_numpy(spark):
    out = LQ.op12_whitening(spark, SF_ORACLE).toPandas().sort_values(["vec_id", "component"])
    rows = spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").toPandas().sort_values("vec_id")
    x, fit, e, z = plain(rows["embedding"].tolist())
    assert out["vec_id"].tolist() == np.repeat(rows["vec_id"].to_numpy(), 16).tolist()
    got = out["whitened"].to_numpy().reshape(-1, 16)
    assert np.abs(got - z * np.sign((got * z).sum(axis=0))).max() < 1e-9
    n, s = len(fit), fit.sum(axis=0)
    assert set(out["n"]) == {n}
    assert (out["deviation"].to_numpy().reshape(-1, 16) == ((n * x - s) ** 2).sum(axis=1)[:, None]).all()
    assert np.allclose(out["explained"][:16], e / np.var(fit, axis=0).sum(), rtol=1e-9)
    assert out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-9


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "x") for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, n string")


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [-1.0, 0.5]), (4, None), (5, [nan, 0.0]), (6, [0.0, inf]),
            (7, [None, 1.0]), (8, []), (9, [1.0]), (None, [1.0, 0.0]), (10, [1e300, 0.0])]
    df = spark.createDataFrame([(i, v, "x", 5) for i, v in rows], "vec_id long, embedding array<double>, n string, component int")
    out = W.whitening(df).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in out) == sorted((i, c) for i in (0, 1, 2, 2, 3) for c in (1, 2))
    assert {r["n"] for r in out} == {3}
    assert W.whitening(df.limit(0)).count() == 0
    assert W.whitening(df.filter("vec_id = 1")).count() == 0      # one distinct vector: no variance
    assert W.whitening(df.filter("vec_id = 8")).count() == 0


def test_multiple_and_zero_roots(spark):
    """Equal variances in two directions, none in a third."""
    vectors = [[a / 64, b / 64, 7.0] for a, b in ((3, 0), (-3, 0), (0, 3), (0, -3))]
    out = W.whitening(frame(spark, vectors)).toPandas()
    assert set(out["component"]) == {1, 2} and np.allclose(out["explained"], 0.5)
    z = out.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.allclose(z.T @ z / 4, np.eye(2)) and out["identity_error"].max() < 1e-12


def test_nearly_equal_roots_are_told_apart(spark):
    """Variances that differ in the thirteenth digit."""
    big = 3_000_000
    vectors = [[big / 64, 0.0], [-big / 64, 0.0], [0.0, (big + 1) / 64], [0.0, -(big + 1) / 64]]
    out = W.whitening(frame(spark, vectors)).toPandas().pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.allclose(np.abs(out), [[0, 2 ** 0.5], [0, 2 ** 0.5], [2 ** 0.5, 0], [2 ** 0.5, 0]], atol=1e-15)


def test_wide_numbers_stay_exact():
    rng = np.random.default_rng(1)
    y = rng.integers(-2 ** 61, 2 ** 61, (300, 3))
    exact = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(3)] for i in range(3)]
    assert W.products(y).tolist() == exact


@pytest.mark.parametrize("seed", range(4))
def test_polynomial_and_roots_of_small_matrices(spark, seed):
    rng = np.random.default_rng(seed)
    b = rng.integers(-9, 9, (5, 3 if seed == 3 else 5))
    m = [[int(v) for v in row] for row in b @ b.T]
    poly = W.characteristic_polynomial(spark, m)
    for t in range(-3, 9):  # det(t - m) by exact elimination
        rows = [[Fraction(t * (i == j) - m[i][j]) for j in range(5)] for i in range(5)]
        det = Fraction(1)
        for j in range(5):
            p = next((i for i in range(j, 5) if rows[i][j]), None)
            if p is None:
                det = Fraction(0)
                break
            if p != j:
                rows[j], rows[p], det = rows[p], rows[j], -det
            det *= rows[j][j]
            for i in range(j + 1, 5):
                f = rows[i][j] / rows[j][j]
                rows[i] = [a - f * c for a, c in zip(rows[i], rows[j])]
        assert sum(c * t ** i for i, c in enumerate(poly)) == det
    roots = [num / 2 ** shift for num, shift, many in W.largest_roots(poly, 5) for _ in range(many)]
    real = sorted(np.linalg.eigvalsh(np.array(m, float)), reverse=True)[:len(roots)]
    assert np.allclose(roots, real) and len(roots) == np.linalg.matrix_rank(np.array(m))
