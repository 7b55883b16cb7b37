import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_search import DIM, asked, points, ranked

from filelake.operators import ann, leaf_tree, vectors


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, DIM)) * 3
    v = centres[rng.integers(0, 40, 1500)] + rng.normal(size=(1500, DIM)) * 0.3
    # A fifth of all rows are copies of one vector.
    v[::5] = v[0]
    return np.float32(v), centres[:9] + rng.normal(size=(9, DIM)) * 0.1


def test_leaves_stay_small_and_hold_every_vector(spark, data, tmp_path, monkeypatch):
    v, q = data
    monkeypatch.setattr(leaf_tree, "CHUNK", 100)
    bad = points(spark, [[float("nan")] * DIM], ["x"]).select(F.lit(-1).cast("bigint").alias("datapoint_id"), "feature_vector")
    tree = leaf_tree.build(points(spark, v).unionByName(bad), DIM, leaf_size=20)
    assert tree.leaves.select("group").distinct().count() == 8 and tree.leaves.count() > 40
    ids = sorted(r.datapoint_id for r in tree.table.select("datapoint_id").collect())
    assert ids == list(range(len(v)))
    sizes = sorted(r["count"] for r in tree.table.groupBy("group", "leaf").count().collect())
    # The copies share one leaf, whatever is done; the others stay near the size wanted.
    assert sizes[-1] >= 300 and np.mean(sizes[:-1]) < 40 and sizes[-2] < 200
    copies = tree.table.where(F.col("datapoint_id") % 5 == 0).select("group", "leaf").distinct()
    assert copies.count() == 1

    # Each vector is in the nearest leaf of its group.
    centres = {(r.group, r.leaf): np.array(r.centroid) for r in tree.leaves.collect()}
    for r in tree.table.where("datapoint_id % 50 = 1").collect():
        far = {leaf: ((np.array(r.feature_vector) - c) ** 2).sum() for (g, leaf), c in centres.items() if g == r.group}
        assert far[r.leaf] == pytest.approx(min(far.values()))

    leaf_tree.write(tree, str(tmp_path / "tree"))
    tree = leaf_tree.read(spark, str(tmp_path / "tree"), DIM)
    truth = vectors.topk(asked(spark, q), points(spark, v), DIM)
    assert ranked(leaf_tree.search(asked(spark, q), tree, 1.0)) == ranked(truth)
    near = leaf_tree.search(asked(spark, q), tree, 0.25)
    assert ann.recall(near, truth).agg(F.avg("recall")).first()[0] >= 0.9
    # The number of queries that can be sent at once changes nothing.
    assert ranked(leaf_tree.search(asked(spark, q), tree, 0.25, max_sent=4)) == ranked(near)
    # Hits come from no more leaves than are searched, and only folders of their groups are read.
    probes = -(-tree.leaves.count() // 4)
    found = near.join(tree.table.select("datapoint_id", "group", "leaf"), "datapoint_id")
    assert found.groupBy("query_id").agg(F.count_distinct("group", "leaf").alias("n")).where(F.col("n") > probes).count() == 0
    assert re.search(r"PartitionFilters: \[.*group", near._jdf.queryExecution().executedPlan().toString())


def test_small_and_empty_trees(spark):
    one = leaf_tree.build(points(spark, np.ones((3, DIM))), DIM)
    assert one.leaves.count() == 1 and one.table.count() == 3
    assert ranked(leaf_tree.search(asked(spark, np.ones((2, DIM)), k=2), one)) == {
        0: [(0, 8.0), (1, 8.0)], 1: [(0, 8.0), (1, 8.0), (2, 8.0)]
    }
    none = leaf_tree.build(points(spark, np.ones((1, DIM))).limit(0), DIM)
    assert none.table.count() == none.leaves.count() == 0
    assert leaf_tree.search(asked(spark, np.ones((2, DIM))), none).count() == 0
    assert leaf_tree.search(asked(spark, np.ones((2, DIM))).limit(0), one).count() == 0
