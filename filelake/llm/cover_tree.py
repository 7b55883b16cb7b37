"""Exact top-k inner products by a dual-tree search over cover trees."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filelake.llm import scratch

# Points of a block and queries of a group: what meets in one task.
BLOCK = 1024
# Points of a leaf, queries of one, and children of a node.
LEAF = 128
QUERY_LEAF = 64
CHILDREN = 16
# Points that the upper nodes are chosen from, and how many upper nodes there are at most.
SAMPLE = 8192
UPPER = 256
# Summaries of groups and blocks that are compared in one task.
CELL = 1024
LOWEST = np.iinfo(np.int64).min


@dataclass(slots=True)
class Node:
    """Points ``rows`` within ``radius`` of the point ``centre``."""

    centre: np.ndarray
    radius: float
    rows: np.ndarray
    children: list[Node] = field(default_factory=list)


def build(x: np.ndarray, leaf: int) -> Node:
    """Cover tree of the points ``x``: children cover their points with half the radius where they can.

    The first child keeps its parent's centre. Further centres are the points farthest from those chosen,
    at most ``CHILDREN`` and no more than leaves would hold the points; if they do not cover all with half the radius, the rest goes to the nearest, and the
    radii say what is really covered.
    """
    centre = x[np.argmin(((x - x.mean(axis=0)) ** 2).sum(axis=1))]
    return _node(x, np.arange(len(x)), centre, leaf)


def _node(x: np.ndarray, rows: np.ndarray, centre: np.ndarray, leaf: int) -> Node:
    own = x[rows]
    nearest = np.sqrt(((own - centre) ** 2).sum(axis=1))
    node = Node(centre, float(nearest.max(initial=0.0)), rows)
    if len(rows) <= leaf or node.radius == 0:
        return node
    centres, owner = [centre], np.zeros(len(rows), dtype=np.int64)
    most = min(CHILDREN, -(-len(rows) // leaf))
    while len(centres) < most and nearest.max() > node.radius / 2:
        new = own[np.argmax(nearest)]
        distance = np.sqrt(((own - new) ** 2).sum(axis=1))
        closer = distance < nearest
        owner[closer], nearest = len(centres), np.where(closer, distance, nearest)
        centres.append(new)
    if len(centres) == 1:
        return node
    node.children = [_node(x, rows[owner == i], c, leaf) for i, c in enumerate(centres) if (owner == i).any()]
    return node


def bound(q: np.ndarray, q_radius: float, p: np.ndarray, p_radius: float) -> float:
    """Largest inner product of points within these radii of ``q`` and ``p``, rounding included."""
    top = q @ p + q_radius * np.sqrt(p @ p) + p_radius * np.sqrt(q @ q) + q_radius * p_radius
    return top + 1e-9 * abs(top) + 1.0


@dataclass
class Best:
    """The best ``k`` of each query so far, by falling score and rising id; ``floor`` is a score they must reach."""

    k: int
    floor: np.ndarray

    def __post_init__(self) -> None:
        n = len(self.floor)
        self.score = np.full((n, self.k), LOWEST, dtype=np.int64)
        self.id = np.full((n, self.k), np.iinfo(np.int64).max, dtype=np.int64)

    def worst(self, rows: np.ndarray) -> float:
        """The least score that may still change the result of one of these queries."""
        return float(np.maximum(self.score[rows, -1], self.floor[rows]).min())

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        # Only queries for which a score may count are ranked anew.
        some = scores.max(axis=1) >= np.maximum(self.score[rows, -1], self.floor[rows])
        if not some.any():
            return
        rows, scores = rows[some], scores[some]
        score = np.concatenate([self.score[rows], scores], axis=1)
        both = np.concatenate([self.id[rows], np.broadcast_to(ids, scores.shape)], axis=1)
        order = np.lexsort((both, -np.maximum(score, LOWEST + 1)), axis=1)[:, : self.k]
        self.score[rows] = np.take_along_axis(score, order, axis=1)
        self.id[rows] = np.where(self.score[rows] > LOWEST, np.take_along_axis(both, order, axis=1), np.iinfo(np.int64).max)


def inner(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Integer inner products, exact: in doubles only where these hold all sums."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(p).max(initial=0)) * q.shape[1]
    if most < 2**53:
        return (q.astype(np.float64) @ p.astype(np.float64).T).astype(np.int64)
    return q @ p.T


def dual_search(q: np.ndarray, q_id: np.ndarray, p: np.ndarray, p_id: np.ndarray, k: int, floor: np.ndarray) -> Best:
    """Best ``k`` points for every query. Pairs of nodes that cannot reach the group's worst kth score are left out."""
    best = Best(k, floor)
    qf, pf = q.astype(np.float64), p.astype(np.float64)

    def visit(a: Node, b: Node) -> None:
        if bound(a.centre, a.radius, b.centre, b.radius) < best.worst(a.rows):
            return
        if not a.children and not b.children:
            scores = inner(q[a.rows], p[b.rows])
            scores[q_id[a.rows][:, None] == p_id[b.rows][None, :]] = LOWEST
            best.add(a.rows, scores, p_id[b.rows])
        elif a.children and (a.radius >= b.radius or not b.children):
            for child in a.children:
                visit(child, b)
        else:
            # The most promising child first, so that the worst kth score rises early.
            for child in sorted(b.children, key=lambda c: -float(a.centre @ c.centre)):
                visit(a, child)

    if len(q) and len(p):
        visit(build(qf, QUERY_LEAF), build(pf, LEAF))
    return best


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


def _near(centres: np.ndarray):
    """Nearest upper node of each point, and the distance to it."""

    @F.pandas_udf("centre int, distance double")
    def of(vectors: pd.Series) -> pd.DataFrame:
        x = _matrix(vectors).astype(np.float64) if len(vectors) else np.zeros((0, centres.shape[1]))
        square = (x**2).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres**2).sum(axis=1)
        found = square.argmin(axis=1) if len(x) else np.zeros(0, dtype=np.int64)
        return pd.DataFrame({"centre": found, "distance": np.sqrt(((x - centres[found]) ** 2).sum(axis=1))})

    return of


def _upper(x: np.ndarray, wanted: int) -> np.ndarray:
    """Centres of about ``wanted`` upper nodes of the cover tree of a sample."""
    level = [build(x, max(1, len(x) // max(1, wanted)))]
    while len(level) < wanted and any(n.children for n in level):
        largest = max((n for n in level if n.children), key=lambda n: len(n.rows))
        level = [n for n in level if n is not largest] + largest.children
    return np.unique(np.array([n.centre for n in level]), axis=0)


def _placed(points: DataFrame, id_col: str, wanted: int, sample: int, name: str) -> tuple[DataFrame, DataFrame]:
    """``points`` with the node ``name`` they belong to, and a summary ``(name, centre, radius)`` of the nodes."""
    picked = points.orderBy(F.xxhash64(id_col), id_col).limit(sample).select("v").toArrow().column("v").combine_chunks()
    x = picked.flatten().to_numpy(zero_copy_only=False).reshape(len(picked), -1).astype(np.float64)
    centres = _upper(x, min(UPPER, wanted))
    near = points.withColumn("__near", _near(centres)("v")).select(
        "*", F.col("__near.centre").alias("__centre"), F.col("__near.distance").alias("__distance")
    ).drop("__near")
    # Of a node with more points than a block, parts by hash. There are at most UPPER nodes to count.
    counts = {r["__centre"]: r["count"] for r in near.groupBy("__centre").count().collect()}
    parts = F.array(*[F.lit(-(-counts.get(i, 1) // BLOCK)) for i in range(len(centres))])
    part = F.pmod(F.xxhash64(id_col, F.lit(3)), F.element_at(parts, F.col("__centre") + 1))
    placed, _ = scratch.put(
        near.withColumn(name, F.col("__centre").cast("long") * (1 << 32) + part).drop("__centre"), f"cover-{name}"
    )
    at = F.array(*[F.array(*[F.lit(float(c)) for c in row]) for row in centres])
    summary = placed.groupBy(name).agg(F.max("__distance").alias("radius")).withColumn(
        "centre", F.element_at(at, (F.col(name) / (1 << 32)).cast("int") + 1)
    )
    return placed.drop("__distance"), summary


def _searched(queries: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """Best ``k`` of every pair of a group and a block: ``queries`` and ``points`` have both keys."""

    def of(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        best = dual_search(
            _matrix(left["v"]), left["query_id"].to_numpy(), _matrix(right["v"]), right["vec_id"].to_numpy(), k,
            left["floor"].to_numpy(),
        )
        some = (best.score > LOWEST) & (best.score >= best.floor[:, None])
        return pd.DataFrame({
            "query_id": np.repeat(left["query_id"].to_numpy(), k)[some.ravel()], "vec_id": best.id[some], "score": best.score[some],
        })

    keys = ["q", "p"]
    return queries.groupBy(*keys).cogroup(points.groupBy(*keys)).applyInPandas(of, "query_id long, vec_id long, score long")


def _pairs(groups: DataFrame, blocks: DataFrame, n_groups: int, n_blocks: int) -> DataFrame:
    """``(q, p, similar)`` of the groups and blocks whose bound reaches the group's worst kth score.

    Only the summaries are compared, ``CELL`` of one side with as many of the other in a task; ``similar`` is
    the inner product of the centres.
    """
    across, down = max(1, -(-n_groups // CELL)), max(1, -(-n_blocks // CELL))
    left = groups.withColumn("cx", F.pmod(F.xxhash64("q"), F.lit(across))).withColumn(
        "cy", F.explode(F.array(*[F.lit(i).cast("long") for i in range(down)]))
    )
    right = blocks.withColumn("cy", F.pmod(F.xxhash64("p"), F.lit(down))).withColumn(
        "cx", F.explode(F.array(*[F.lit(i).cast("long") for i in range(across)]))
    )

    def of(g: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(g) and len(b):
            c, r = np.stack(b["centre"].to_numpy()), b["radius"].to_numpy()
            norm = np.sqrt((c**2).sum(axis=1))
            for q, centre, radius, worst in zip(g["q"], g["centre"], g["radius"], g["worst"]):
                centre = np.array(centre)
                similar = c @ centre
                top = similar + radius * norm + r * np.sqrt(centre @ centre) + radius * r
                for i in np.nonzero(top + 1e-9 * np.abs(top) + 1.0 >= worst)[0]:
                    found.append((q, b["p"].iloc[i], similar[i]))
        return pd.DataFrame(found, columns=["q", "p", "similar"]).astype({"q": "int64", "p": "int64", "similar": "float64"})

    return left.groupBy("cx", "cy").cogroup(right.groupBy("cx", "cy")).applyInPandas(of, "q long, p long, similar double")


def top_k(points: DataFrame, queries: DataFrame, k: int, sample: int = SAMPLE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each of ``queries (query_id, v)`` the best of ``points (vec_id, v)``.

    ``v`` are arrays of whole numbers of one length, without nulls, whose inner products fit 64 bits; the score
    is the inner product. The ``k`` highest are returned (all, if there are fewer), ties to the smaller id. A
    point with the query's own id is no candidate. Of points with equal ``v``, which tie for every query, only
    the first ``k + 1`` ids can be in a result and are kept; so groups of copies of any size need no care.
    Queries that repeat id and ``v`` count once. Without points or queries there are no rows.

    Upper nodes of one cover tree are chosen on a sample of ``sample`` points; every point and query goes to
    its nearest one. Groups of queries first search the block nearest to them; pairs of groups and blocks
    whose covering radii cannot reach the worst kth score of the group are left out, all others are searched by two
    cover trees in a task, pruning in the same way.
    """
    by_vector = Window.partitionBy("v").orderBy("vec_id")
    points = points.select("vec_id", "v").distinct().withColumn("n", F.row_number().over(by_vector)).filter(F.col("n") <= k + 1).drop("n")
    points, _ = scratch.put(points, "cover-points")
    queries, _ = scratch.put(queries.select("query_id", "v").distinct(), "cover-queries")
    n_points, n_queries = points.count(), queries.count()
    nothing = points.select(
        F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")
    ).limit(0)
    if not n_points or not n_queries:
        return nothing
    points, blocks = _placed(points, "vec_id", -(-2 * n_points // BLOCK), sample, "p")
    queries, groups = _placed(queries, "query_id", -(-n_queries // BLOCK), sample, "q")
    blocks, _ = scratch.put(blocks, "cover-blocks")
    groups, _ = scratch.put(groups, "cover-groups")
    n_blocks, n_groups = blocks.count(), groups.count()

    # The block that looks best to a group gives the scores that the others must reach.
    unknown = groups.withColumn("worst", F.lit(float("-inf")))
    nearest = Window.partitionBy("q").orderBy(F.desc("similar"), "p")
    first = _pairs(unknown, blocks, n_groups, n_blocks).withColumn("n", F.row_number().over(nearest)).filter("n = 1")
    first, _ = scratch.put(first.select("q", "p"), "cover-first")
    lowest = F.lit(int(LOWEST)).cast("long")
    seeded = _searched(queries.withColumn("floor", lowest).join(first, "q"), points.join(first, "p"), k)
    floors = seeded.groupBy("query_id").agg(F.min("score").alias("score"), F.count("*").alias("n"))
    floors = floors.select("query_id", F.when(F.col("n") == k, F.col("score")).alias("known"))
    queries, _ = scratch.put(
        queries.join(floors, "query_id", "left").withColumn("floor", F.coalesce("known", lowest)).drop("known"), "cover-floors"
    )
    worst = queries.groupBy("q").agg(F.min("floor").cast("double").alias("worst"))
    pairs, _ = scratch.put(_pairs(groups.join(worst, "q"), blocks, n_groups, n_blocks).select("q", "p"), "cover-pairs")
    found = _searched(queries.join(pairs, "q"), points.join(pairs, "p"), k)
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def scaled(embedding: Column, scale: float = 256.0) -> Column:
    """Components as whole numbers, rounded down; null for vectors that are null or hold null or non-finite ones."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite, F.transform(embedding, lambda x: F.floor(F.lit(scale) * x.cast("double"))))
