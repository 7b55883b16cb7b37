import numpy as np

from filelake.llm import cover_tree


def brute(q, q_id, p, p_id, k):
    out = []
    for v, i in zip(q, q_id):
        scored = sorted((-int(np.dot(v, w)), int(j)) for w, j in zip(p, p_id) if j != i)[:k]
        out += [(int(i), n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return sorted(out)


def points(seed, n, dim=8, spread=3):
    random = np.random.default_rng(seed)
    centres = random.integers(-200, 200, (12, dim))
    return centres[random.integers(0, 12, n)] + random.integers(-spread, spread + 1, (n, dim))


def run(spark, x, ids, q, q_ids, k):
    p = spark.createDataFrame([(int(i), [int(c) for c in v]) for i, v in zip(ids, x)], "vec_id long, v array<long>")
    s = spark.createDataFrame([(int(i), [int(c) for c in v]) for i, v in zip(q_ids, q)], "query_id long, v array<long>")
    return sorted(tuple(r) for r in cover_tree.top_k(p, s, k).select("query_id", "rank", "vec_id", "score").collect())


def test_tree_covers_its_points():
    x = points(1, 3000).astype(float)
    todo, leaves = [cover_tree.build(x, 64)], []
    while todo:
        node = todo.pop()
        assert np.sqrt(((x[node.rows] - node.centre) ** 2).sum(axis=1)).max() <= node.radius + 1e-9
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
            todo += node.children
        else:
            leaves.append(node)
    assert len(leaves) > 10


def test_search_in_a_task_is_exact_and_prunes(monkeypatch):
    monkeypatch.setattr(cover_tree, "LEAF", 16)
    monkeypatch.setattr(cover_tree, "QUERY_LEAF", 16)
    x, q = points(2, 2000), points(2, 400)
    seen = []
    plain = cover_tree.inner
    monkeypatch.setattr(cover_tree, "inner", lambda a, b: seen.append(a.shape[0] * b.shape[0]) or plain(a, b))
    best = cover_tree.dual_search(q, np.arange(400), x, np.arange(2000), 5, np.full(400, cover_tree.LOWEST))
    ours = sorted((i, r + 1, int(best.id[i, r]), int(best.score[i, r])) for i in range(400) for r in range(5))
    assert ours == brute(q, range(400), x, range(2000), 5)
    assert sum(seen) < 0.5 * 400 * 2000


def test_all_blocks_and_groups(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "BLOCK", 64)
    monkeypatch.setattr(cover_tree, "CELL", 3)
    x = points(3, 900)
    ids, q_ids = np.arange(900) * 2, np.arange(0, 900, 7) * 2
    assert run(spark, x, ids, x[q_ids // 2], q_ids, 5) == brute(x[q_ids // 2], q_ids, x, ids, 5)


def test_ties_copies_and_few_points(spark):
    x = np.array([[1, 2]] * 30 + [[2, 1]] * 3 + [[0, 0], [-5, 0]])
    ids = np.arange(len(x))[::-1]
    assert run(spark, x, ids, x, ids, 5) == brute(x, ids, x, ids, 5)
    assert run(spark, x[:2], [4, 9], x[:2], [4, 9], 5) == [(4, 1, 9, 5), (9, 1, 4, 5)]
    assert run(spark, x[:1], [4], x[:1], [4], 5) == []
    assert run(spark, x[:0], [], x[:1], [4], 5) == run(spark, x[:1], [4], x[:0], [], 5) == []


def test_large_numbers_stay_exact(spark):
    x = np.array([[2**30 + i, -(2**30) + 3 * i] for i in range(6)])
    assert run(spark, x, range(6), x, range(6), 3) == brute(x, range(6), x.astype(object), range(6), 3)


def test_scaled(spark):
    rows = [([0.5, -0.001],), ([None, 1.0],), ([float("nan")],), ([float("inf")],), (None,), ([],)]
    df = spark.createDataFrame(rows, "e array<float>").select(cover_tree.scaled("e").alias("v"))
    assert [r["v"] for r in df.collect()] == [[128, -1], None, None, None, None, []]


def test_repeated_rows_do_not_push_out_ids_of_equal_vectors(spark):
    x, ids = [[1, 2, 3]] * 11, [1] * 6 + [2, 3, 4, 5, 6]
    assert run(spark, x, ids, [[1, 0, 0]], [50], 5) == [(50, n, n, 1) for n in range(1, 6)]
