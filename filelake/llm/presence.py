"""Ranked lexical search: documents of an item grouped by the mask of terms they hold, best masks first."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filelake.llm import scratch

# Bytes of query texts that are searched in one pass over the documents.
QUERY_BYTES = 8 * 1024**2
# Documents that are grouped and scored together in a task.
DOCS = 8192
# What stands between terms, and the letters that are lower-cased.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
TO_TERMS = bytes(ord(" ") if b in SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """All terms of a UTF-8 text in order. Bytes beyond ASCII belong to terms and stay as they are."""
    return text.translate(TO_TERMS).split() if text else []


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2.0 * documents + 2) / (2.0 * holding + 1)))


def gains(tf: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a term with weight 1 adds to the score of a document with ``n`` terms."""
    m = 100 - 25 + (25 * n * documents) // total
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _counted(vocabulary: dict[bytes, int]):
    """Per document its number of terms, and the numbers and counts of those that any query asks for."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for key, text in zip(part.column("id").to_pylist(), part.column("text").cast(pa.binary()).to_pylist()):
                    found = Counter(terms := terms_of(text))
                    own = sorted((vocabulary[t], c) for t, c in found.items() if t in vocabulary)
                    if terms:
                        both = np.array(own, dtype="<i4").reshape(-1, 2)
                        rows.append((key, len(terms), both[:, 0].tobytes(), both[:, 1].tobytes()))
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["id", "n", "terms", "tfs"])

    return of


def _holding(size: int):
    """Documents of a task that hold each term."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            numbers = np.frombuffer(b"".join(batch.column("terms").to_pylist()), dtype="<i4")
            total += np.bincount(numbers, minlength=size)
        held = np.nonzero(total)[0]
        yield pa.record_batch({"term": pa.array(held, pa.int32()), "df": pa.array(total[held], pa.int64())})

    return of


class Block:
    """Postings of a few thousand documents, by term and then by document, with their gains and the terms' bitmaps."""

    def __init__(self, n: np.ndarray, terms: list[bytes], tfs: list[bytes], weights: np.ndarray, documents: int, total: int):
        self.size = len(n)
        sizes = np.array([len(t) // 4 for t in terms])
        doc = np.repeat(np.arange(self.size), sizes)
        term = np.frombuffer(b"".join(terms), dtype="<i4").astype(np.int64)
        tf = np.frombuffer(b"".join(tfs), dtype="<i4").astype(np.int64)
        gain = weights[term] * gains(tf, n[doc], documents, total)
        self.keys = term * self.size + doc
        order = np.argsort(self.keys)
        self.keys, self.gain = self.keys[order], gain[order]
        self.bounds = np.searchsorted(self.keys, np.arange(len(weights) + 1) * self.size)
        self.most = np.zeros(len(weights), dtype=np.int64)
        held = np.nonzero(np.diff(self.bounds))[0]
        if len(held):
            self.most[held] = np.maximum.reduceat(self.gain, self.bounds[held])
        self.bitmaps: dict[int, np.ndarray] = {}

    def bitmap(self, term: int) -> np.ndarray:
        """The documents that hold a term, a bit each."""
        if term not in self.bitmaps:
            flags = np.zeros(self.size, dtype=np.uint8)
            flags[self.keys[self.bounds[term] : self.bounds[term + 1]] - term * self.size] = 1
            self.bitmaps[term] = np.packbits(flags)
        return self.bitmaps[term]

    def masks(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(documents, group, held)``: documents with any of the terms, the number of each one's mask, and the masks."""
        rows = np.stack([self.bitmap(t) for t in terms.tolist()])
        some = np.nonzero(np.unpackbits(np.bitwise_or.reduce(rows), count=self.size))[0]
        # Bits of the terms next to each other: the mask of a document is a row of bytes.
        packed = np.packbits(np.unpackbits(rows, axis=1, count=self.size)[:, some], axis=0).T
        width = -(-packed.shape[1] // 8) * 8
        padded = np.zeros((len(some), width), dtype=np.uint8)
        padded[:, : packed.shape[1]] = packed
        kind = np.uint64 if width == 8 else np.dtype((np.void, width))
        distinct, group = np.unique(padded.view(kind).ravel(), return_inverse=True)
        held = np.unpackbits(distinct.view(np.uint8).reshape(-1, width), axis=1, count=len(terms))
        return some, group.ravel(), held

    def scores(self, docs: np.ndarray, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        wanted = (terms[:, None] * self.size + docs).ravel()
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        gain = np.where(self.keys[at] == wanted, self.gain[at], 0).reshape(len(terms), -1)
        return times @ gain


class Best:
    """The best ``k`` documents of every query so far."""

    def __init__(self, k: int):
        self.k, self.scored, self.grouped = k, 0, 0
        self.found: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def worst(self, query: int) -> int:
        """Score that a further document must reach: the kth best, or 1."""
        score = self.found.get(query, ((), ()))[0]
        return max(1, int(score[-1])) if len(score) >= self.k else 1

    def add(self, query: int, score: np.ndarray, ids: np.ndarray) -> None:
        own = score > 0
        before = self.found.get(query, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        score, ids = np.concatenate([before[0], score[own]]), np.concatenate([before[1], ids[own]])
        order = np.lexsort((ids, -score))[: self.k]
        self.found[query] = score[order], ids[order]

    def search(self, query: int, block: Block, ids: np.ndarray, terms: np.ndarray, times: np.ndarray) -> None:
        """Masks by falling highest score; it is finished when the next mask cannot reach the kth score."""
        here = block.most[terms] > 0
        terms, times = terms[here], times[here]
        if not len(terms):
            return
        docs, group, held = block.masks(terms)
        highest = held.astype(np.int64) @ (times * block.most[terms])
        rank = np.argsort(np.argsort(-highest, kind="stable"), kind="stable")[group]
        order = np.argsort(rank, kind="stable")
        docs, highest = docs[order], highest[group[order]]
        self.grouped += len(docs)
        at, step = 0, 4 * self.k
        # Documents with equal scores go by their ids, so a mask that can just reach the kth score counts.
        while at < len(docs) and highest[at] >= self.worst(query):
            upto = min(len(docs), at + step)
            upto = max(at + 1, at + int((highest[at:upto] >= self.worst(query)).sum()))
            self.add(query, block.scores(docs[at:upto], terms, times), ids[docs[at:upto]])
            self.scored += upto - at
            at, step = upto, 2 * step


NO_ID = np.iinfo(np.int64).max


def _search(asked: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, documents: int, total: int, k: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS):
                part = batch.slice(at, DOCS)
                ids = part.column("id").fill_null(NO_ID).to_numpy()
                n = part.column("n").to_numpy()
                block = Block(n, part.column("terms").to_pylist(), part.column("tfs").to_pylist(), weights, documents, total)
                for query, (terms, times) in enumerate(asked):
                    best.search(query, block, ids, terms, times)
        for query, (score, ids) in best.found.items():
            yield pa.record_batch({
                "query": pa.array(np.full(len(score), query), pa.int32()),
                "id": pa.array(ids, pa.int64(), mask=ids == NO_ID), "score": pa.array(score, pa.int64()),
            })

    return of


def search(
    docs: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", query_id: str = "item_id",
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """The ``k`` documents with the highest score above 0 for every query: ``(<query_id>, rank, <id_col>, score)``.

    A term is a longest run of ASCII letters, digits and characters beyond ASCII; only A-Z are lower-cased. The score
    is the sum over the query's terms, repeats included, of a whole-number weight that falls with the documents that hold
    the term, times a gain that rises with its count and falls with the document's length (``weight``, ``gains``).
    Equal scores go by ascending id, rows without an id last. A null or empty text has no terms: such a document counts
    nowhere, such a query has no results. Repeated rows of either table count as often as they occur, each query row with
    ranks of its own. Other columns are not read. Empty tables give no rows.

    Queries are searched in blocks of at most ``query_bytes`` of text (one longer text alone), each in one pass over the
    texts; what is kept of a document are the counts of terms that the block asks for. A task returns its best ``k``
    for every query of the block.
    """
    spark = docs.sparkSession
    sized = queries.select(F.col(query_id).alias("item"), F.col(text_col).alias("text")).filter("text is not null")
    size = sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // query_bytes))
    # Row numbers deal the queries evenly, equal ones too.
    dealt, path = scratch.put(sized.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(blocks))), "queries")
    result = None
    for number in range(blocks):
        own = dealt.filter(F.col("block") == number).select("item", "text").collect()
        found = _search_block(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), own, dealt.schema["item"].dataType, k)
        result = found if result is None else result.union(found)
    scratch.drop(spark, path)
    return result.select(F.col("item").alias(query_id), "rank", F.col("id").alias(id_col), "score")


def _search_block(docs: DataFrame, own: list, kind, k: int) -> DataFrame:
    spark = docs.sparkSession
    per_query = [Counter(terms_of(r["text"].encode("utf-8", "surrogatepass"))) for r in own]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*per_query)))}
    counted, _ = scratch.put(docs.mapInArrow(_counted(vocabulary), "id long, n long, terms binary, tfs binary"), "counted")
    documents, total = counted.agg(F.count("*"), F.sum("n")).first()
    held = counted.select("terms").mapInArrow(_holding(len(vocabulary)), "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    weights = np.zeros(len(vocabulary), dtype=np.int64)
    for row in held.collect():
        weights[row["term"]] = weight(documents, row["df"])
    asked = []
    for terms in per_query:
        pairs = np.array(sorted((vocabulary[t], c) for t, c in terms.items()), dtype=np.int64).reshape(-1, 2)
        asked.append((pairs[:, 0], pairs[:, 1]))
    best = counted.mapInArrow(_search(asked, weights, documents, total or 0, k), "query int, id long, score long")
    by = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = best.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
    names = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(own)], f"query int, item {kind.simpleString()}")
    return ranked.join(F.broadcast(names), "query").select("item", "rank", "id", "score")
