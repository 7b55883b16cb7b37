"""Near-duplicate vectors: iterative quantisation, multi-index Hamming tables, rerank by the vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filelake.llm import runs, scratch
from filelake.llm.components import connected_components

COSINE = 0.95
# Vectors that the rotations are learnt from, those with the smallest hash of their id.
SAMPLE = 20_000
ITERATIONS = 50
BITS = 64
# Expected part of the pairs at the cosine itself that the tables find; nearer ones are found more often.
RECALL = 0.97
SEED = 5
# Standard deviations of the Hamming distance of a pair at the cosine that still pass to the rerank.
SLACK = 5.0


@dataclass
class Codes:
    """Rotations that make codes, and the tables over substrings of these."""

    rotations: np.ndarray
    bits: int
    # Of each table: its set of codes, first bit and number of bits.
    tables: list[tuple[int, int, int]]
    farthest: int

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Codes of unit vectors: one unsigned number for each rotation."""
        signs = np.stack([x @ r > 0 for r in self.rotations], axis=1)
        weights = np.uint64(1) << np.arange(self.bits, dtype=np.uint64)
        return (signs * weights).sum(axis=2, dtype=np.uint64)


def unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def learn_rotation(x: np.ndarray, start: np.ndarray, iterations: int = ITERATIONS) -> np.ndarray:
    """Rotation of projected vectors that brings them nearest to the corners of a cube."""
    r = start
    for _ in range(iterations):
        corners = np.where(x @ r > 0, 1.0, -1.0)
        u, _, vt = np.linalg.svd(x.T @ corners)
        r = u @ vt
    return r


def fit(sample: np.ndarray, n: int, cosine: float = COSINE, recall: float = RECALL, seed: int = SEED) -> Codes:
    """Codes for ``n`` vectors, learnt from ``sample`` (unit vectors).

    Substrings have about log2(n) bits, so that a table's buckets stay small at every size. A table finds
    the pairs that differ in at most one bit of its substring; there are as many as ``recall`` needs, over
    several rotations where one has too few substrings. Vectors are not centred: cosines are angles at the
    origin, and the mean of a corpus with one large group of near copies lies among these, where every
    plane through it would part them.
    """
    x = sample
    bits = min(BITS, x.shape[1])
    values, vectors = np.linalg.eigh(x.T @ x)
    project = vectors[:, np.argsort(-values)[:bits]]
    width = min(bits, 40, max(4, math.ceil(math.log2(max(n, 2)))))
    in_code = max(1, round(bits / width))
    flip = math.acos(cosine) / math.pi
    size = bits / in_code
    meets = (1 - flip) ** size + size * flip * (1 - flip) ** (size - 1)
    wanted = max(in_code, math.ceil(math.log(1 - recall) / math.log(1 - meets)))
    edges = [round(i * bits / in_code) for i in range(in_code + 1)]
    tables = [(t // in_code, edges[t % in_code], edges[t % in_code + 1] - edges[t % in_code]) for t in range(wanted)]
    random = np.random.default_rng(seed)
    rotations = []
    for _ in range(tables[-1][0] + 1):
        start = np.linalg.qr(random.standard_normal((bits, bits)))[0]
        rotations.append(project @ learn_rotation(x @ project, start))
    farthest = math.floor(bits * flip + SLACK * math.sqrt(bits * flip * (1 - flip)))
    return Codes(np.array(rotations), bits, tables, farthest)


def valid(embedding: Column) -> Column:
    """Vectors that can be compared: not null, not empty, all components finite, not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embedding.isNotNull() & finite & F.exists(embedding, lambda x: x != 0)


def _vectors(batch: pa.RecordBatch | pa.Table, name: str = "embedding") -> np.ndarray:
    column = batch.column(name)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _encoded(codes: Codes):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = codes.encode(unit(_vectors(batch))).view(np.int64)
                yield pa.record_batch({"rep": batch.column("rep"), "codes": pa.array(list(made), pa.list_(pa.int64()))})

    return of


def table_keys(codes_col: str, codes: Codes) -> Column:
    """Array of a vector's keys: for each table and each bit of its substring, the rest of the substring."""
    keys = []
    for number, (own, first, size) in enumerate(codes.tables):
        part = F.shiftrightunsigned(F.col(codes_col)[own], first).bitwiseAND(F.lit((1 << size) - 1))
        for bit in range(size):
            rest = part.bitwiseAND(F.lit(((1 << size) - 1) & ~(1 << bit)))
            keys.append(rest.bitwiseOR(F.lit((number * 64 + bit) << 48)))
    return F.array(*keys)


def _first_key(codes: Codes, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number (table and bit) of the first key that two codes share."""
    first = np.full(len(a), -1, dtype=np.int64)
    for number, (own, start, size) in reversed(list(enumerate(codes.tables))):
        differ = ((a[:, own] ^ b[:, own]) >> np.uint64(start)) & np.uint64((1 << size) - 1)
        bit = np.bitwise_count(differ - np.uint64(1) & ~differ).astype(np.int64)
        found = np.bitwise_count(differ)
        first = np.where(found == 0, number * 64, np.where(found == 1, number * 64 + bit, first))
    return first


def _candidates(codes: Codes, table: pa.Table, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a run with near codes, each pair only under its first shared key."""
    own = _vectors(table, "codes").view(np.uint64)
    number = (table.column("key").to_numpy() >> 48) & 0xFFFF
    cell, one = table.column("cell").to_numpy(), table.column("left").to_numpy() == table.column("right").to_numpy()
    for a, b in runs.pairs_by_distance(end):
        near = (np.bitwise_count(own[a, 0] ^ own[b, 0]) <= codes.farthest) & (one[a] | (cell[a] != cell[b]))
        a, b = a[near], b[near]
        if len(a):
            here = _first_key(codes, own[a], own[b]) == number[a]
            if here.any():
                yield a[here], b[here]


def _survivors(codes: Codes):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, end in runs.whole_runs(batches, ["key", "left", "right"]):
            keep = np.zeros(table.num_rows, dtype=bool)
            for a, b in _candidates(codes, table, end):
                keep[a] = keep[b] = True
            yield from table.filter(pa.array(keep)).to_batches()

    return of


def _verified(codes: Codes, cosine: float):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, end in runs.whole_runs(batches, ["key", "left", "right"]):
            x, n = unit(_vectors(table)), table.num_rows
            rep, size = table.column("rep").to_numpy(), table.column("size").to_numpy()
            label, links = np.arange(n), np.zeros(n, dtype=np.int64)
            for a, b in _candidates(codes, table, end):
                close = np.einsum("ij,ij->i", x[a], x[b]) >= cosine
                a, b = a[close], b[close]
                np.add.at(links, a, size[b])
                np.add.at(links, b, size[a])
                label = runs.join_labels(label, a, b)
            some = np.nonzero(links)[0]
            yield pa.record_batch({"u": rep[some], "v": rep[label[some]], "links": links[some]})

    return of


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, sample: int = SAMPLE
) -> DataFrame:
    """One row per row of ``vectors``: ``(<id_col>, n_links, component_id, kept)``.

    Vectors are linked if their cosine, in double precision, is at least ``cosine``; the tables find all but
    a few of these pairs (see ``fit``; exact copies always), the rerank lets no other through. ``n_links`` counts the other
    ids linked directly, ``component_id`` is the smallest id reachable, the row's own included, and
    ``kept`` tells whether it is the row's own.

    Null, empty and zero vectors and those with null or non-finite components link with nothing. Vectors of
    another length than most are compared with none of a different length. A null id links with nothing. Rows
    that repeat an id and its vector count once; an id with several vectors has the links of each on that
    row. No rows give no rows. Other columns are not read. The rotations are fitted on at most ``sample``
    vectors; every vector is indexed and searched.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).alias("embedding"))
    usable = rows.filter(valid(F.col("embedding")) & F.col("_id").isNotNull())
    copies, _ = scratch.put(
        usable.groupBy("embedding").agg(F.min("_id").alias("rep"), F.count_distinct("_id").alias("size")), "itq-vectors"
    )
    lengths = copies.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").collect()
    empty = copies.select(F.col("rep").alias("u"), F.col("rep").alias("v"), F.col("size").alias("links")).limit(0)
    found = empty
    for dim, n in lengths:
        found = found.union(_links(copies.filter(F.size("embedding") == dim), n, cosine, sample))
    found, _ = scratch.put(found, "itq-links")
    groups = connected_components(found.select("u", "v"), "itq-groups")
    direct = found.groupBy("u").agg(F.sum("links").alias("links"))
    of_copy = (
        copies.join(direct, F.col("rep") == F.col("u"), "left")
        .join(groups, F.col("rep") == F.col("node"), "left")
        .select(
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    linked = F.col("embedding").isNotNull() & F.col("_id").isNotNull()
    out = rows.join(of_copy.withColumnRenamed("embedding", "__v"), (F.col("embedding") == F.col("__v")) & linked, "left")
    component = F.coalesce("component", "_id")
    return out.select(
        F.col("_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("_id").eqNullSafe(component).alias("kept"),
    )


def _links(copies: DataFrame, n: int, cosine: float, sample: int) -> DataFrame:
    """``(u, v, links)``: ids of linked different vectors, with the number of ids linked to ``u`` under one key."""
    picked = copies.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("embedding").toArrow()
    codes = fit(unit(_vectors(picked)), n, cosine)
    coded = copies.mapInArrow(_encoded(codes), "rep long, codes array<long>")
    keyed = coded.select("rep", "codes", F.explode(table_keys("codes", codes)).alias("key"))
    cells = runs.into_cells(keyed, "key", F.xxhash64("rep"))
    columns = ["key", "left", "right", "cell", "rep", "codes"]
    near = runs.sorted_runs(cells, "key").select(*columns).mapInArrow(
        _survivors(codes), "key long, left int, right int, cell int, rep long, codes array<long>"
    )
    with_vectors = near.join(copies.select("rep", "embedding", "size"), "rep").select(*columns, "embedding", "size")
    return runs.sorted_runs(with_vectors, "key").select(*columns, "embedding", "size").mapInArrow(
        _verified(codes, cosine), "u long, v long, links long"
    )
