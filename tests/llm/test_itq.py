import math

import numpy as np
import pytest

from filelake.llm import itq

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, size string"


def clusters(seed=1, dim=64):
    """Unit vectors: alone, with near copies at many distances, and one large group of near copies."""
    random = np.random.default_rng(seed)
    base = random.standard_normal((250, dim))
    base /= np.linalg.norm(base, axis=1)[:, None]
    made = [base]
    for spread in (0.01, 0.1, 0.2, 0.3):
        noise = random.standard_normal((60, dim)) / math.sqrt(dim)
        made.append(base[:60] + spread * noise)
    made.append(base[100] + 0.1 * random.standard_normal((300, dim)) / math.sqrt(dim))
    return np.concatenate(made).astype(np.float32)


def brute(ids, x):
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    linked = unit @ unit.T >= itq.COSINE
    group = list(ids)
    for _ in range(len(ids)):
        new = [min(group[j] for j in np.nonzero(row)[0]) for row in linked]
        if new == group:
            break
        group = new
    return linked, group


def run(spark, rows):
    df = spark.createDataFrame([(i, v, None, "x", "y") for i, v in rows], SCHEMA)
    return itq.near_duplicates(df).collect()


def test_recall_against_brute_force(spark):
    x = clusters()
    rows = [(i * 3, [float(c) for c in v]) for i, v in enumerate(x)]
    found = {r["vec_id"]: r for r in run(spark, rows)}
    linked, group = brute([i for i, _ in rows], x)
    true = linked.sum(axis=1) - 1
    ours = np.array([found[i]["n_links"] for i, _ in rows])
    assert (ours <= true).all() and ours.sum() >= 0.97 * true.sum()
    same = np.mean([found[i]["component_id"] == g for (i, _), g in zip(rows, group)])
    assert same > 0.98
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())


def test_odd_vectors(spark):
    v, w = [1.0, 2.0, 3.0, 4.0] * 4, [-4.0, 3.0, 2.0, -1.0] * 4
    odd = [None, [], [0.0] * 16, [float("nan")] + v[1:], [float("inf")] + v[1:], [None] + v[1:]]
    rows = [(10, v), (11, v), (12, [2 * c for c in v]), (12, [2 * c for c in v]), (13, w), (None, v), (14, v[:8]), (15, v[:8])]
    rows += [(20 + i, o) for i, o in enumerate(odd)]
    found = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in run(spark, rows)), key=str)
    wanted = [(10, 2, 10, True), (11, 2, 10, False), (12, 2, 10, False), (12, 2, 10, False), (13, 0, 13, True), (None, 0, None, True),
              (14, 1, 14, True), (15, 1, 14, False)] + [(20 + i, 0, 20 + i, True) for i in range(len(odd))]
    assert found == sorted(wanted, key=str)
    assert run(spark, []) == [] and len(run(spark, [(1, None)])) == 1


def test_large_buckets_are_cut_into_cells(spark, monkeypatch):
    monkeypatch.setattr(itq.runs.into_cells, "__defaults__", (32,))
    x = clusters(2)[-300:]
    found = run(spark, [(i, [float(c) for c in v]) for i, v in enumerate(x)])
    linked, _ = brute(list(range(300)), x)
    assert [r["n_links"] for r in sorted(found, key=lambda r: r["vec_id"])] == (linked.sum(axis=1) - 1).tolist()


@pytest.mark.parametrize("n", [10, 1_000, 50_000, 10**9])
def test_tables_follow_the_number_of_vectors(n):
    codes = itq.fit(itq.unit(np.random.default_rng(0).standard_normal((500, 64))), n)
    sizes = [size for _, _, size in codes.tables]
    assert abs(np.mean(sizes) - min(40, max(4, math.log2(n)))) < 0.35 * np.mean(sizes) and max(sizes) <= 48
    q = math.acos(0.95) / math.pi
    missed = np.prod([1 - (1 - q) ** s - s * q * (1 - q) ** (s - 1) for s in sizes])
    assert missed <= 0.05


def test_first_shared_key():
    codes = itq.fit(itq.unit(np.random.default_rng(0).standard_normal((500, 64))), 50_000)
    random = np.random.default_rng(3)
    a = random.integers(0, 2**63, (200, len(codes.rotations)), dtype=np.uint64)
    b = a ^ (np.uint64(1) << random.integers(0, 64, a.shape).astype(np.uint64)) ^ (random.integers(0, 2, a.shape).astype(np.uint64) << np.uint64(5))

    def keys(x):
        out = []
        for number, (own, first, size) in enumerate(codes.tables):
            part = int(x[own]) >> first & (1 << size) - 1
            out += [(number * 64 + bit, part & ~(1 << bit)) for bit in range(size)]
        return out

    wanted = [next((k for k, _ in (p for p in keys(x) if p in set(keys(y)))), -1) for x, y in zip(a, b)]
    assert itq._first_key(codes, a, b).tolist() == wanted
