"""Whitening against eigenvectors of the exact covariance."""

import math

import numpy as np
import pytest

from filelake.llm import whitening as W


def plain(vectors):
    """``(n, exact deviations, eigenvalues, eigenvectors, whitened)`` from Python integers and numpy's solver."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    y = [[n * a - s for a, s in zip(row, sums)] for row in x]
    centred = np.array(y, dtype=float) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    values, directions = values[order], directions[:, order]
    return n, [sum(a * a for a in row) for row in y], values, directions, centred @ directions / np.sqrt(np.abs(values) + 1e-300)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def random_rows(n, d, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + rng.normal(size=d) * 5
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]


def test_against_plain(spark):
    rows = random_rows(300, 40)
    got = W.components_long(table(spark, rows).repartition(5)).collect()
    n, deviation, values, _, z = plain([v for _, v in rows])
    assert len(got) == 300 * 32
    assert {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1
    assert got[0]["identity_error"] < 1e-9
    signs = {}
    for r in got:
        i, k = r["vec_id"], r["component"] - 1
        assert r["deviation"] == deviation[i]
        assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9)
        signs.setdefault(k, np.sign(r["whitened"] * z[i, k]))
        assert r["whitened"] * signs[k] == pytest.approx(z[i, k], abs=1e-8)


def test_cholesky_and_jacobi():
    rng = np.random.default_rng(3)
    for d, rank in ((1, 1), (2, 2), (7, 3), (33, 33), (64, 20)):
        b = rng.normal(size=(d, rank)) * 10.0 ** rng.uniform(-3, 3, rank)
        a = b @ b.T
        f = W.pivoted_cholesky(a)
        assert f.shape[1] <= d and np.allclose(f @ f.T, a, atol=1e-12 * np.abs(a).max())
        values, directions = W.jacobi(f)
        assert np.allclose(directions.T @ directions, np.eye(len(values)), atol=1e-10)
        wanted = np.sort(np.linalg.eigvalsh(a))[::-1][: len(values)]
        assert np.allclose(values, wanted, rtol=1e-6, atol=1e-12 * wanted[0])


def test_few_directions_give_few_components(spark):
    rows = [(i, [float(i), 2.0 * i, -1.0]) for i in range(9)]
    got = W.components_long(table(spark, rows)).collect()
    assert len(got) == 9 and {r["component"] for r in got} == {1} and got[0]["explained"] == pytest.approx(1)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, -4.0]), (None, [0.0, 1.0]), (3, None), (4, []), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [None, 1.0]), (8, [1.0]), (9, [-inf, 0.0]), (10, [0.5, 0.25]),
    ]
    extra = "*, 1 as component, 2 as n, 'x' as row, 'y' as at, 3 as value, 4 as whitened, 5 as tile"
    got = W.components_long(table(spark, rows).selectExpr(*extra.split(", "))).collect()
    used = [[1, 2], [1, 2], [3, -4], [0, 1], [0.5, 0.25]]
    n, deviation, *_ = plain(used)
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0) for r in got) == sorted([(False, 1)] * 4 + [(False, 2)] * 2 + [(True, 0)] * 2 + [(False, 10)] * 2)
    assert {r["deviation"] for r in got} == set(deviation) and {r["n"] for r in got} == {n}
    kept, _ = W.whiten(table(spark, rows).selectExpr(*extra.split(", ")))
    assert kept.columns == ["vec_id", "embedding", "component", "n", "row", "at", "value", "tile", "deviation", "whitened"]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(4)]])
def test_nothing_to_whiten(spark, rows):
    assert W.components_long(table(spark, rows)).count() == 0


def test_deviation_beyond_64_bits(spark):
    rows = [(0, [1e30]), (1, [-1e30]), (2, [0.0])]
    got = {r["vec_id"]: r["deviation"] for r in W.components_long(table(spark, rows)).collect()}
    far = int(W.LARGEST)
    assert got[2] == (3 * 1_000_000 - 3 * 1_000_000) ** 2 and got[0] is None and (3 * far) ** 2 > 2**63
