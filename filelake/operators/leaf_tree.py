"""Approximate top-k over a tree of two levels: groups of leaves, each leaf about as large at any number of vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filelake import constants as C
from filelake.operators import skew
from filelake.operators.vectors import (
    MAX_SENT_BYTES, MAX_SENT_QUERIES, _result_schema, _to_arrow, dense, keep_best, ranked_batch, topk, valid_vector,
)
from filelake.session import small_side, stage

# Vectors that the groups, and the leaves of a group, are fitted on, for each of them on average. All are assigned.
PER_GROUP = 256
PER_LEAF = 16
# Vectors of a group that are assigned to its leaves in one task.
CHUNK = 8192


@dataclass(frozen=True)
class LeafTree:
    """``table`` is ``(datapoint_id, feature_vector, group, leaf)``, leaves counted within their group;
    ``leaves`` is ``(group, leaf, centroid)``."""

    table: DataFrame
    leaves: DataFrame
    dim: int


def build(vectors: DataFrame, dim: int, leaf_size: int = C.LEAF_SIZE, seed: int = 7, iterations: int = 10) -> LeafTree:
    """Cluster ``(datapoint_id, feature_vector)`` into groups, and each group into leaves of about ``leaf_size``.

    There are about as many groups as leaves in a group, so the groups' centroids stay small (bounded by
    what may be sent) while the leaves' are a table. Centroids are fitted on a part of the
    vectors, ``PER_GROUP`` for a group and ``PER_LEAF`` for a leaf; every vector is assigned. A group is dealt to
    tasks in chunks, so one that holds a third of all vectors is no longer task. Invalid vectors are left out;
    equal ones share a leaf. No vectors give an empty tree.
    """
    spark = vectors.sparkSession
    usable = vectors.where(valid_vector(F.col("feature_vector"), dim)).select("datapoint_id", "feature_vector")
    # Rows of a written table have the same number each time they are read.
    usable = stage(usable.withColumn("_u", F.rand(seed)), "vectors")
    n = usable.count()
    wanted = max(1, min(math.isqrt(math.ceil(n / leaf_size)), MAX_SENT_BYTES // (8 * dim)))
    if wanted == 1:
        grouped = usable.withColumn("group", F.lit(0))
    else:
        features = usable.withColumn("features", array_to_vector("feature_vector"))
        model = KMeans(k=wanted, seed=seed, maxIter=iterations, predictionCol="group").fit(
            features.where(F.col("_u") < PER_GROUP * wanted / n)
        )
        grouped = stage(model.transform(features).drop("features"), "grouped")

    # One row a group.
    sizes = grouped.groupBy("group").agg(F.count(F.lit(1)).alias("n")).select(
        "group", F.ceil(F.col("n") / leaf_size).cast("int").alias("k"), F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"), "n"
    )
    sizes = small_side(sizes, "group-sizes")
    known = grouped.join(sizes, "group")
    # Drawn anew within a group: its vectors may all be among the first by their number.
    draw = F.pmod(F.xxhash64("_u"), F.lit(1_000_000)) / 1_000_000
    part = known.where(draw < F.greatest(F.col("k") * PER_LEAF, F.lit(PER_GROUP)) / F.col("n"))
    sampled = part.select("group", "k", "feature_vector").unionByName(
        # A group whose draw is empty still has a leaf.
        grouped.groupBy("group").agg(F.min_by("feature_vector", "_u").alias("feature_vector")).withColumn("k", F.lit(0)).select("group", "k", "feature_vector")
    )

    def fit(table: pa.Table) -> pa.Table:
        group, rows = table["group"][0].as_py(), dense(table["feature_vector"], dim)
        centres = _lloyd(rows, max(table["k"].to_pylist() + [1]), iterations, seed)
        return pa.table({
            "group": pa.array([group] * len(centres), pa.int32()), "leaf": pa.array(range(len(centres)), pa.int32()),
            "centroid": pa.array(list(centres), pa.list_(pa.float64())),
        })

    leaves = stage(sampled.groupBy("group").applyInArrow(fit, "group int, leaf int, centroid array<double>"), "leaves")
    dealt = known.withColumn("chunk", F.pmod(F.xxhash64("_u", "datapoint_id"), F.col("chunks")).cast("int"))
    copies = leaves.join(sizes, "group").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))

    def assign(rows: pa.Table, centres: pa.Table) -> pa.Table:
        if rows.num_rows == 0:
            return rows.select(["datapoint_id", "feature_vector", "group"]).append_column("leaf", pa.array([], pa.int32()))
        near = _nearest(dense(rows["feature_vector"], dim), dense(centres["centroid"], dim))
        leaf = pa.array(centres["leaf"].to_numpy()[near].astype(np.int32))
        return rows.select(["datapoint_id", "feature_vector", "group"]).append_column("leaf", leaf)

    keys = ["group", "chunk"]
    columns = dealt.select("datapoint_id", "feature_vector", "group", "chunk")
    schema = columns.drop("chunk").withColumn("leaf", F.lit(0)).schema
    table = columns.groupBy(*keys).cogroup(copies.select(*keys, "leaf", "centroid").groupBy(*keys)).applyInArrow(assign, schema)
    return LeafTree(stage(table, "tree"), leaves, dim)


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest of ``centres`` to each row, the first of equal ones."""
    size = (centres * centres).sum(axis=1)
    step = max(1, 4_000_000 // len(centres))
    return np.concatenate([np.argmin(size - 2 * rows[i : i + step] @ centres.T, axis=1) for i in range(0, len(rows), step)])


def _lloyd(rows: np.ndarray, k: int, iterations: int, seed: int) -> np.ndarray:
    """At most ``k`` centres of ``rows`` by k-means, started from different rows; centres of nothing are left out."""
    rows = rows[np.lexsort(rows.T)]
    unique = np.unique(rows, axis=0)
    centres = unique[np.sort(np.random.default_rng(seed).permutation(len(unique))[:k])]
    for _ in range(iterations):
        near = _nearest(rows, centres)
        n = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        centres = sums[n > 0] / n[n > 0, None]
    return centres


def write(tree: LeafTree, path: str) -> None:
    """Vectors by group and in order of their leaves, so that a search reads the folders and parts it needs."""
    tree.table.sortWithinPartitions("group", "leaf").write.partitionBy("group").mode("overwrite").parquet(f"{path}/vectors")
    tree.leaves.write.mode("overwrite").parquet(f"{path}/leaves")


def read(spark: SparkSession, path: str, dim: int) -> LeafTree:
    return LeafTree(spark.read.parquet(f"{path}/vectors"), spark.read.parquet(f"{path}/leaves"), dim)


def search(queries: DataFrame, tree: LeafTree, fraction: float = C.LEAF_SEARCH_FRACTION, max_sent: int = MAX_SENT_QUERIES) -> DataFrame:
    """Top-k over the best ``fraction`` of all leaves for each query, at least one.

    Leaves are ranked by the dot product of query and centroid, where their table lies: that costs one
    vector product for all vectors of a leaf, so groups are not ranked first, which would lose those whose own
    centroid says little. The (query, leaf) pairs join the vectors; inside a leaf the ranking is exact, and with
    a fraction of 1 the answer is that of ``topk``. Queries go in blocks of at most ``max_sent``, with the same answers.
    """
    k_max = int(queries.agg(F.max("k")).first()[0] or 0)
    asked = queries.where(valid_vector(F.col("vector"), tree.dim)).select("query_id", "vector")
    n = asked.count()
    if n == 0 or k_max == 0 or fraction >= 1:
        return topk(queries, tree.table, tree.dim, max_sent)
    bound = max(1, min(max_sent, MAX_SENT_BYTES // (8 * tree.dim)))
    blocks = math.ceil(n / bound)
    asked = stage(asked.withColumn("_block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))), "asked")
    probes = max(1, math.ceil(fraction * tree.leaves.count()))
    schema = _result_schema(queries, tree.table)
    candidates = None
    for number in range(blocks):
        # A block by hash may hold a few more than the bound; it is cut, never sent whole.
        sent = asked.where(F.col("_block") == number).select("query_id", "vector").toArrow()
        for start in range(0, sent.num_rows, bound):
            block = sent.slice(start, bound)
            found = _search_block(block, probed_leaves(block, tree, probes), tree, k_max, schema)
            candidates = found if candidates is None else candidates.unionByName(found)
    best = skew.top_k(candidates, "query_id", [F.col("distance").desc(), F.col("datapoint_id")], k_max)
    return best.join(queries.select("query_id", "k"), "query_id").where(F.col("rank") <= F.col("k")).drop("k")


def probed_leaves(sent: pa.Table, tree: LeafTree, probes: int) -> DataFrame:
    """``(q, group, leaf)``: for each query in ``sent``, by its place, the leaves it searches."""
    shared = tree.table.sparkSession.sparkContext.broadcast(dense(sent["vector"], tree.dim))
    dim = tree.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                score = np.round(matrix @ dense(part.column("centroid"), dim).T, C.SCORE_DIGITS)
                at = pa.array(np.tile(np.arange(part.num_rows), len(matrix)))
                q = pa.array(np.repeat(np.arange(len(matrix), dtype=np.int32), part.num_rows))
                columns = [q, part.column("group").take(at), part.column("leaf").take(at), pa.array(score.ravel())]
                yield pa.record_batch(columns, ["q", "group", "leaf", "score"])

    scored = tree.leaves.select("group", "leaf", "centroid").mapInArrow(run, "q int, group int, leaf int, score double")
    return skew.top_k(scored, "q", [F.col("score").desc(), F.col("group"), F.col("leaf")], probes).select("q", "group", "leaf")


def _search_block(sent: pa.Table, probed: DataFrame, tree: LeafTree, k: int, schema) -> DataFrame:
    """Candidates of the queries in ``sent`` from the leaves they probe."""
    dim = tree.dim
    shared = tree.table.sparkSession.sparkContext.broadcast((sent["query_id"].to_pandas().to_numpy(), dense(sent["vector"], dim)))
    asking = small_side(probed.groupBy("group", "leaf").agg(F.sort_array(F.collect_list("q")).alias("asking")), "probed")
    # One row a group at most: a partition filter when the table is stored by group.
    groups = [r.group for r in asking.select("group").distinct().collect()]
    near = tree.table.where(F.col("group").isin(groups)).join(asking, ["group", "leaf"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, rows = shared.value
        best = None
        for batch in batches:
            vectors = dense(batch.column(1), dim)
            code = batch.column(2).to_numpy().astype(np.int64) << 32 | batch.column(3).to_numpy()
            parts = [] if best is None else [best]
            for one in np.unique(code):
                here = np.flatnonzero(code == one)
                q = batch.column(4)[int(here[0])].values.to_numpy()
                parts.append(ranked_batch(query_ids[q], rows[q], batch.column(0).take(pa.array(here)), vectors[here], k))
            if parts:
                best = keep_best(pd.concat(parts, ignore_index=True), k)
        if best is not None:
            yield from _to_arrow(best).to_batches()

    columns = near.select("datapoint_id", "feature_vector", F.col("group").cast("int"), F.col("leaf").cast("int"), "asking")
    return columns.mapInArrow(run, schema)
