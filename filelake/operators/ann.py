"""Approximate top-k: vectors clustered into leaves, of which a query searches the nearest few."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filelake import constants as C
from filelake.operators import skew
from filelake.operators.vectors import (
    MAX_SENT_BYTES, MAX_SENT_QUERIES, _result_schema, _to_arrow, dense, keep_best, ranked_batch, topk, valid_vector,
)
from filelake.session import stage


@dataclass(frozen=True)
class LeafIndex:
    """``table`` is ``(datapoint_id, feature_vector, leaf)``; ``centroids`` has one row per leaf."""

    table: DataFrame
    centroids: np.ndarray
    dim: int


def n_leaves(n_vectors: int, dim: int, leaf_size: int = C.LEAF_SIZE) -> int:
    """About ``leaf_size`` vectors a leaf, with all centroids within the bound sent to every task."""
    return max(1, min(math.ceil(n_vectors / leaf_size), MAX_SENT_BYTES // (8 * dim)))


def build(vectors: DataFrame, dim: int, leaf_size: int = C.LEAF_SIZE, seed: int = 7, iterations: int = 10) -> LeafIndex:
    """Cluster ``(datapoint_id, feature_vector)`` with distributed k-means and assign every vector."""
    usable = vectors.where(valid_vector(F.col("feature_vector"), dim)).select("datapoint_id", "feature_vector")
    features = usable.withColumn("features", array_to_vector("feature_vector"))
    k = n_leaves(usable.count(), dim, leaf_size)
    if k == 1:
        # k-means wants two clusters; one leaf needs no clustering.
        return LeafIndex(usable.withColumn("leaf", F.lit(0)), np.zeros((1, dim)), dim)
    model = KMeans(k=k, seed=seed, maxIter=iterations, predictionCol="leaf").fit(features)
    return LeafIndex(model.transform(features).drop("features"), np.array(model.clusterCenters()), dim)


def write(index: LeafIndex, path: str) -> None:
    """Vectors by leaf, so that a search reads the folders of its leaves only."""
    spark = index.table.sparkSession
    index.table.write.partitionBy("leaf").mode("overwrite").parquet(f"{path}/leaves")
    rows = [(n, [float(x) for x in c]) for n, c in enumerate(index.centroids)]
    spark.createDataFrame(rows, "leaf int, centroid array<double>").write.mode("overwrite").parquet(f"{path}/centroids")


def read(spark, path: str) -> LeafIndex:
    rows = spark.read.parquet(f"{path}/centroids").orderBy("leaf").toArrow()
    dim = len(rows["centroid"][0])
    return LeafIndex(spark.read.parquet(f"{path}/leaves"), dense(rows["centroid"], dim), dim)


def search(
    queries: DataFrame, index: LeafIndex, probes: int | None = None, max_sent: int = MAX_SENT_QUERIES
) -> DataFrame:
    """Top-k over the ``probes`` best leaves per query, by default a tenth of them.

    Leaves are ranked by the dot product of query and centroid, the measure of the search itself. Inside
    the searched leaves the ranking is exact, so probing all leaves equals ``topk``. More than
    ``max_sent`` queries are searched in blocks of this size one after another, each reading the leaves it
    needs: the answer does not depend on the number of queries.
    """
    leaves = len(index.centroids)
    probes = min(leaves, probes or math.ceil(C.LEAF_SEARCH_FRACTION * leaves))
    k_max = int(queries.agg(F.max("k")).first()[0] or 0)
    asked = queries.where(valid_vector(F.col("vector"), index.dim)).select("query_id", "vector")
    bound = max(1, min(max_sent, MAX_SENT_BYTES // (8 * index.dim)))
    n = asked.count()
    if n == 0 or k_max == 0 or probes == leaves:
        return topk(queries, index.table, index.dim, max_sent)
    blocks = math.ceil(n / bound)
    asked = stage(asked.withColumn("_block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))), "asked")
    candidates = None
    for number in range(blocks):
        # A block by hash may hold a few more than the bound; it is cut, never sent whole.
        sent = asked.where(F.col("_block") == number).select("query_id", "vector").toArrow()
        for start in range(0, sent.num_rows, bound):
            found = _search_block(sent.slice(start, bound), index, probes, k_max, _result_schema(queries, index.table))
            candidates = found if candidates is None else candidates.unionByName(found)
    best = skew.top_k(candidates, "query_id", [F.col("distance").desc(), F.col("datapoint_id")], k_max)
    return best.join(queries.select("query_id", "k"), "query_id").where(F.col("rank") <= F.col("k")).drop("k")


def _search_block(sent: pa.Table, index: LeafIndex, probes: int, k: int, schema) -> DataFrame:
    """Candidates of the queries in ``sent`` from the leaves they probe."""
    matrix = dense(sent["vector"], index.dim)
    probed = np.argsort(-(matrix @ index.centroids.T), axis=1, kind="stable")[:, :probes]
    # Queries of each leaf, by one sort of all (leaf, query) pairs.
    order = np.argsort(probed.ravel(), kind="stable")
    searched, starts = np.unique(probed.ravel()[order], return_index=True)
    of_leaf = dict(zip(searched.tolist(), np.split(order // probes, starts[1:])))
    shared = index.table.sparkSession.sparkContext.broadcast((sent["query_id"].to_pandas().to_numpy(), matrix, of_leaf))
    dim = index.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, rows, queries_of = shared.value
        best = None
        for batch in batches:
            vectors, leaf_of = dense(batch.column(1), dim), batch.column(2).to_numpy()
            parts = [] if best is None else [best]
            for leaf in np.unique(leaf_of):
                here, asking = np.flatnonzero(leaf_of == leaf), queries_of[int(leaf)]
                ids = batch.column(0).take(pa.array(here))
                parts.append(ranked_batch(query_ids[asking], rows[asking], ids, vectors[here], k))
            if parts:
                best = keep_best(pd.concat(parts, ignore_index=True), k)
        if best is not None:
            yield from _to_arrow(best).to_batches()

    # At most as many leaf numbers as centroids: a partition filter when the table is stored by leaf.
    near = index.table.where(F.col("leaf").isin(searched.tolist()))
    return near.select("datapoint_id", "feature_vector", F.col("leaf").cast("int")).mapInArrow(run, schema)


def recall(found: DataFrame, truth: DataFrame) -> DataFrame:
    """Share of the true neighbours that were found, per query."""
    hit = found.select("query_id", "datapoint_id", F.lit(True).alias("hit"))
    return truth.join(hit, ["query_id", "datapoint_id"], "left").groupBy("query_id").agg(
        (F.count_if(F.col("hit").isNotNull()) / F.count(F.lit(1))).alias("recall")
    )


