"""Vector table: encoding, exact top-k by dot product, upserts and the incremental embed plan."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filelake import constants as C
from filelake.functions import text as X
from filelake.operators import skew
from filelake.session import send_if_small, small_side, spread, spread_paths, stage
from filelake.sources.files import read_bytes

# Most query vectors that are sent to every task at once, and their size in bytes.
MAX_SENT_QUERIES = 4096
MAX_SENT_BYTES = 64 * 1024**2
# Vectors of one cell of the query-block x vector-block grid used beyond that.
GRID_VECTORS = 50_000
# Scores held in memory at a time while one batch is ranked.
_SCORE_CELLS = 4_000_000


def valid_vector(vector: Column, dim: int) -> Column:
    """Right length, and every component a number."""
    return (F.size(vector) == dim) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x))


def category_restrict(category: str = "images") -> Column:
    """Tag stored with each datapoint."""
    return F.array(F.struct(F.lit("category").alias("namespace"), F.array(F.lit(category)).alias("allow_list")))


def allows(restricts: Column, namespace: str, token: str) -> Column:
    """Query-time filter on the stored tags."""
    return F.exists(
        restricts, lambda r: (r["namespace"] == namespace) & F.array_contains(r["allow_list"], token)
    )


# --- text and image encoding -------------------------------------------------------------------


def _hashed(texts: DataFrame, key: str, text: str, dim: int) -> DataFrame:
    """``(key, cells)``: the non-zero components of the unit-length text vector, at most ``dim``."""
    rows, _ = spread(texts.select(key, text), key)
    terms = X.each(rows, [key], X.tokens(F.col(text)), "_term")
    counts = terms.groupBy(key, X.term_bucket(F.col("_term"), dim).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )
    packed = counts.groupBy(key).agg(
        F.collect_list(F.struct("bucket", "n")).alias("counts"),
        F.sqrt(F.sum(F.col("n") * F.col("n")).cast("double")).alias("norm"),
    )
    return packed.select(key, F.transform(
        "counts", lambda c: F.struct(c["bucket"].alias("bucket"), (c["n"] / F.col("norm")).alias("weight"))
    ).alias("cells"))


def text_weights(texts: DataFrame, key: str, text: str, dim: int) -> DataFrame:
    """Non-zero components ``(key, bucket, weight)`` of the hashed, unit-length text vector."""
    return _hashed(texts, key, text, dim).select(key, F.inline("cells"))


def text_vectors(texts: DataFrame, key: str, text: str, dim: int) -> DataFrame:
    """``texts`` with the dense ``vector`` of each. A text without a token has the zero vector."""
    cells = _hashed(texts, key, text, dim).select(key, F.map_from_entries("cells").alias("cells"))
    buckets = F.sequence(F.lit(0).cast("bigint"), F.lit(dim - 1).cast("bigint"))
    dense = F.transform(buckets, lambda b: F.coalesce(F.try_element_at("cells", b), F.lit(0.0)))
    return texts.join(cells, key, "left").withColumn("vector", dense).drop("cells")


def hashing_encoder(dim: int) -> Callable[[bytes], np.ndarray]:
    """Encoder for content that is text: the Python twin of ``text_vectors``."""
    pattern = re.compile(r"[^\W_]+")
    bucket_of: dict[str, int] = {}

    def encode(content: bytes) -> np.ndarray:
        vector = np.zeros(dim)
        for term in pattern.findall(content.decode("utf-8").lower()):
            bucket = bucket_of.get(term)
            if bucket is None:
                if len(bucket_of) > 100_000:
                    bucket_of.clear()
                bucket = bucket_of[term] = int(hashlib.md5(term.encode()).hexdigest()[:8], 16) % dim
            vector[bucket] += 1.0
        norm = np.linalg.norm(vector)
        return vector / norm if norm else vector[:0]

    return encode


def encode_batch(
    objects: DataFrame, make_encoder: Callable[[], Callable[[bytes], np.ndarray]], dim: int
) -> DataFrame:
    """Vector per object of ``(file_id, rev, content)`` or ``(file_id, rev, uri)``, or the error that object met.

    With ``uri`` the task that encodes an object opens it, so that no bytes are shuffled and none are
    read but those of these rows. ``make_encoder`` runs once per task. A row that fails, or whose vector is empty or of another
    length, gets an ``error`` and leaves the other rows alone.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = make_encoder()
        for batch in batches:
            rows = []
            for file_id, rev, content in batch.itertuples(index=False):
                try:
                    if by_uri:
                        content = read_bytes(content)
                    vector = np.asarray(encode(content), dtype=np.float32)
                    if len(vector) != dim:
                        raise ValueError("empty vector" if not len(vector) else f"dimension {len(vector)}")
                    rows.append((file_id, rev, vector, None))
                except Exception as error:
                    rows.append((file_id, rev, None, f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(rows, columns=["file_id", "rev", "feature_vector", "error"])

    by_uri = "uri" in objects.columns
    if by_uri:
        rows = spread_paths(objects.select("file_id", "rev", "uri"))
    else:
        rows, _ = spread(objects.select("file_id", "rev", "content"), "file_id")
    return rows.mapInPandas(
        run, "file_id string, rev string, feature_vector array<float>, error string"
    )


# --- exact top-k -------------------------------------------------------------------------------


def dense(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Matrix of an Arrow list column whose lists all have length ``dim``; a null is not a number."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dim)


def best_of(queries: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query row, vector row, score)`` of the best ``k`` vectors per query.

    Scores are rounded before they are ranked. Of equal scores the earlier vector row wins, so
    identical vectors never give more than ``k`` rows.
    """
    found = []
    step = max(1, _SCORE_CELLS // max(1, len(vectors)))
    for start in range(0, len(queries), step):
        scores = np.round(queries[start : start + step] @ vectors.T, C.SCORE_DIGITS) + 0.0
        if len(vectors) > k:
            kth = np.partition(scores, len(vectors) - k, axis=1)[:, len(vectors) - k, None]
            above = scores > kth
            level = scores == kth
            keep = above | (level & (np.cumsum(level, axis=1) <= k - above.sum(axis=1, keepdims=True)))
        else:
            keep = np.ones(scores.shape, dtype=bool)
        q, v = np.nonzero(keep)
        found.append((q + start, v, scores[q, v]))
    return tuple(np.concatenate(part) for part in zip(*found))


def keep_best(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Best ``k`` rows per query of ``(q, id, score)``."""
    ordered = rows.sort_values(["q", "score", "id"], ascending=[True, False, True], kind="stable")
    return ordered.groupby("q", sort=False).head(k)


def ranked_batch(query_ids: np.ndarray, queries: np.ndarray, ids: pa.Array, vectors: np.ndarray, k: int) -> pd.DataFrame:
    """Candidates of one batch of vectors as ``(q, id, score)``; vectors with a NaN never rank."""
    order = pc.sort_indices(ids)
    order = order.filter(pa.array(~np.isnan(vectors).any(axis=1)[order.to_numpy()]))
    q, v, score = best_of(queries, vectors[order.to_numpy()], k)
    return pd.DataFrame({"q": query_ids[q], "id": ids.take(order).take(pa.array(v)).to_pandas().to_numpy(), "score": score})


def _result_schema(queries: DataFrame, vectors: DataFrame) -> T.StructType:
    return T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("datapoint_id", vectors.schema["datapoint_id"].dataType),
        T.StructField("distance", T.DoubleType()),
    ])


def _to_arrow(rows: pd.DataFrame) -> pa.Table:
    return pa.table({
        "query_id": pa.array(rows["q"]), "datapoint_id": pa.array(rows["id"]), "distance": pa.array(rows["score"])
    })


def sent_queries(queries: DataFrame, columns: list[str], max_rows: int, dim: int) -> pa.Table | None:
    """The query rows if they are few enough to send to every task, else None.

    Fetches one row more than the bound and no further, so the check is itself bounded.
    """
    bound = min(max_rows, MAX_SENT_BYTES // (8 * dim))
    table = queries.select(*columns).limit(bound + 1).toArrow()
    return table if table.num_rows <= bound else None


def topk(queries: DataFrame, vectors: DataFrame, dim: int, max_sent: int = MAX_SENT_QUERIES) -> DataFrame:
    """Exact nearest vectors by dot product, larger is closer.

    ``queries`` is ``(query_id, vector, k)``, ``vectors`` is ``(datapoint_id, feature_vector)``.
    The result is ``(query_id, datapoint_id, distance, rank)`` with scores rounded to 6 digits and
    ties broken by id.

    Query vectors within the checked bound go to every task; each task multiplies its vectors with
    all of them, keeps k candidates per query, and only those are shuffled: the vector table itself
    never moves. More queries than that are split into blocks and joined with blocks of vectors.
    Neither way emits the pairs.
    """
    k_max = queries.agg(F.max("k")).first()[0] or 0
    # Components are checked in the tasks, as matrices, and not one by one here.
    usable = vectors.where(F.size("feature_vector") == dim).select("datapoint_id", "feature_vector")
    asked = queries.where(valid_vector(F.col("vector"), dim))
    schema = _result_schema(queries, vectors)
    sent = sent_queries(asked, ["query_id", "vector"], max_sent, dim)
    if sent is None:
        candidates = _grid(asked, usable, dim, k_max, max_sent, schema)
    elif sent.num_rows == 0 or k_max == 0:
        return queries.sparkSession.createDataFrame([], schema).withColumn("rank", F.lit(0))
    else:
        candidates = _sent(sent, usable, dim, k_max, schema)
    by = [F.col("distance").desc(), F.col("datapoint_id")]
    best = skew.top_k(candidates, "query_id", by, int(k_max))
    return best.join(queries.select("query_id", "k"), "query_id").where(F.col("rank") <= F.col("k")).drop("k")


def _sent(sent: pa.Table, vectors: DataFrame, dim: int, k: int, schema: T.StructType) -> DataFrame:
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(
        (sent["query_id"].to_pandas().to_numpy(), dense(sent["vector"], dim))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, matrix = shared.value
        best = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            new = ranked_batch(query_ids, matrix, batch.column(0), dense(batch.column(1), dim), k)
            best = new if best is None else keep_best(pd.concat([best, new], ignore_index=True), k)
        if best is not None:
            yield from _to_arrow(best).to_batches()

    return vectors.mapInArrow(run, schema)


def _grid(
    queries: DataFrame, vectors: DataFrame, dim: int, k: int, max_sent: int, schema: T.StructType
) -> DataFrame:
    block = min(max_sent, MAX_SENT_BYTES // (8 * dim))
    n_q = math.ceil(queries.count() / block)
    n_v = max(1, math.ceil(vectors.count() / GRID_VECTORS))

    def blocks(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = vectors.select(
        "datapoint_id", "feature_vector",
        F.pmod(F.xxhash64("datapoint_id"), F.lit(n_v)).cast("int").alias("vb"), blocks(n_q).alias("qb"),
    )
    right = queries.select(
        "query_id", "vector",
        F.pmod(F.xxhash64("query_id"), F.lit(n_q)).cast("int").alias("qb"), blocks(n_v).alias("vb"),
    )

    def run(some_vectors: pa.Table, some_queries: pa.Table) -> pa.Table:
        if not some_vectors.num_rows or not some_queries.num_rows:
            return _to_arrow(pd.DataFrame({"q": [], "id": [], "score": []})).slice(0, 0).cast(empty)
        return _to_arrow(ranked_batch(
            some_queries["query_id"].to_pandas().to_numpy(), dense(some_queries["vector"], dim),
            some_vectors["datapoint_id"].combine_chunks(), dense(some_vectors["feature_vector"], dim), k,
        ))

    from pyspark.sql.pandas.types import to_arrow_schema

    empty = to_arrow_schema(schema)
    return left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb")).applyInArrow(run, schema)


# --- incremental maintenance -------------------------------------------------------------------


def embed_plan(images: DataFrame, state: DataFrame) -> DataFrame:
    """What the next embedding run does per id: embedded, skipped, skipped_size or removed.

    ``images`` is ``(file_id, rev, size)``, ``state`` is ``(file_id, rev)`` as last embedded. The
    revision is compared before the size, so an image that outgrew the limit keeps its old vector.
    """
    now = images.select("file_id", F.col("rev").alias("new_rev"), "size", F.lit(True).alias("here"))
    old = state.select("file_id", F.col("rev").alias("old_rev"))
    action = (
        F.when(F.col("here").isNull(), "removed")
        .when(F.col("new_rev") == F.col("old_rev"), "skipped")
        .when(F.coalesce("size", F.lit(0)) > C.MAX_IMAGE_BYTES, "skipped_size")
        .otherwise("embedded")
    )
    both = now.join(old, "file_id", "full_outer")
    return both.select("file_id", F.coalesce("new_rev", "old_rev").alias("rev"), action.alias("action"))


def pending(images: DataFrame, state: DataFrame) -> DataFrame:
    """Images whose revision is not the embedded one."""
    return images.join(state.select("file_id", "rev"), ["file_id", "rev"], "left_anti")


def stale(state: DataFrame, images: DataFrame) -> DataFrame:
    """State rows whose image is gone."""
    return state.join(images.select("file_id"), "file_id", "left_anti")


def upsert(datapoints: DataFrame, new: DataFrame) -> DataFrame:
    """Datapoints with ``new`` replacing or joining them by id.

    The new rows are written once, so that the vector table need not be shuffled to meet them.
    """
    new = stage(new, "upsert")
    kept = datapoints.join(send_if_small(new.select("datapoint_id")), "datapoint_id", "left_anti")
    return kept.unionByName(new)


def remove(datapoints: DataFrame, gone: DataFrame) -> DataFrame:
    """Datapoints without the ids in ``gone``; unknown ids are no error."""
    ids = small_side(gone.select("datapoint_id").distinct(), "removed")
    return datapoints.join(ids, "datapoint_id", "left_anti")
