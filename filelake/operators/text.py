"""Text index and ranked search: postings, BM25 top pages, totals, snippets, incremental import."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filelake import constants as C
from filelake.functions import text as X
from filelake.operators import skew
from filelake.operators.vectors import keep_best
from filelake.session import small_side, spread, spread_evenly, stage

# Queries whose terms are sent to every task at once; more are searched in blocks of this size.
MAX_QUERIES = 4096
# Cells of the matrix of scores, queries by documents, that a task holds.
MAX_CELLS = 2_000_000

# Terms of documents that a task works on at once; a batch that Spark hands over may hold many times more.
MAX_TERMS = 500_000

# Bytes of text that a task splits at once.
MAX_TEXT = 3_000_000
# ASCII bytes in lower case, those that are no letters or digits as spaces; bytes beyond ASCII as they are.
_PLAIN = np.array([b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)], dtype=np.uint8)
_PLAIN[65:91] += 32

# Not a term: marks the one row per document that its own counts hang on.
_WHOLE = ""


def tokenized(docs: DataFrame) -> DataFrame:
    """``(doc_id, dl, toks)`` of ``(doc_id, text)``; tokens of the whole text in order."""
    return _tokenized(docs)[0]


def _tokenized(docs: DataFrame) -> tuple[DataFrame, bool]:
    rows, moved = spread(docs.select("doc_id", "text"), "doc_id")
    return _tokens_of(rows), moved


def _tokens_of(rows: DataFrame) -> DataFrame:
    rows = rows.select("doc_id", X.tokens(F.col("text")).alias("toks"))
    return rows.withColumn("dl", F.size("toks").cast("bigint"))


def parts(batch: pa.RecordBatch, sizes: np.ndarray, most: int = MAX_TERMS) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows whose ``sizes`` add up to at most ``most``; a larger row is one by itself."""
    ends, start, done = np.cumsum(sizes), 0, 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(start, end - start)
        start, done = end, ends[end - 1]


def by_terms(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """``parts`` of all batches by the lengths of the lists in ``column``."""
    for batch in batches:
        yield from parts(batch, pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy())


def split_terms(plain: pa.Array) -> pa.ListArray:
    """Tokens of each of some ``functions.text.plain`` texts, the same as ``functions.text.tokens`` finds."""
    plain = plain.cast(pa.string())
    _, ends, data = plain.buffers()
    ends = np.frombuffer(ends, np.int32)[plain.offset : plain.offset + len(plain) + 1] if len(plain) else np.zeros(1, np.int32)
    data = _PLAIN[np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]] if data else np.zeros(0, np.uint8)
    clean = pc.ascii_trim_whitespace(pa.StringArray.from_buffers(len(plain), pa.py_buffer(ends - ends[0]), pa.py_buffer(data)))
    toks = pc.ascii_split_whitespace(clean)
    # A text without tokens is split into one that is empty.
    some = pc.greater(pc.binary_length(clean), 0)
    sizes = pc.if_else(some, pc.list_value_length(toks), 0).to_numpy()
    words = toks.flatten() if pc.all(some).as_py() else toks.filter(some).flatten()
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), words)


def postings(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Inverted index ``(term, doc_id, tf, dl)``, for the given ``(term)`` rows only if set.

    Rows are spread by document, which is unique, not by term: the commonest word is in most
    documents. A search that groups by document then needs no further shuffle. Of all terms it is the texts
    that are spread, which are several times smaller than their postings.
    """
    rows, moved = _tokenized(docs) if terms is not None else (_tokens_of(spread_evenly(docs.select("doc_id", "text"), "doc_id")), True)
    words = X.each(rows, ["doc_id", "dl"], F.col("toks"), "term")
    if terms is not None:
        words = words.join(terms.select("term"), "term", "left_semi")
        words = words if moved else words.repartition("doc_id")
    return words.groupBy("doc_id", "dl", "term").agg(F.count(F.lit(1)).alias("tf"))


def doc_stats(docs: DataFrame) -> DataFrame:
    return tokenized(docs).select("doc_id", "dl")


def query_terms(queries: DataFrame) -> DataFrame:
    """Distinct ``(query_id, term)`` of the query texts."""
    return X.each(queries, ["query_id"], F.array_distinct(X.tokens(F.col("text"))), "term")


def wanted_terms(terms: DataFrame) -> DataFrame:
    """Distinct terms of the queries, with the mark for whole documents; small and of known size."""
    whole = terms.sparkSession.range(1).select(F.lit(_WHOLE).alias("term"))
    return small_side(terms.select("term").unionByName(whole).distinct(), "wanted-terms")


def corpus_term_stats(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Document frequency of each wanted term with the corpus totals, in one pass over the texts.

    ``(term, df, n_docs, avg_dl)``. Counts combine map-side, so a word found everywhere is one row
    per task.
    """
    marked = X.each(tokenized(docs), ["dl"], F.concat(F.array(F.lit(_WHOLE)), F.array_distinct("toks")), "term")
    return _stats_of(marked, wanted)


def index_term_stats(index: DataFrame, stats: DataFrame, wanted: DataFrame) -> DataFrame:
    """The same from a stored index: ``postings`` and ``doc_stats`` tables."""
    marked = index.select("dl", "term").unionByName(stats.select("dl", F.lit(_WHOLE).alias("term")))
    return _stats_of(marked, wanted)


def _stats_of(marked: DataFrame, wanted: DataFrame) -> DataFrame:
    counted = marked.join(wanted, "term", "left_semi").groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("dl").alias("sum_dl")
    )
    # One row per wanted term. Written, because it is read for the terms and for the totals.
    counted = stage(counted, "terms")
    whole = counted.where(F.col("term") == _WHOLE)
    n_docs = whole.select("df").scalar()
    total = whole.select("sum_dl").scalar()
    return counted.where(F.col("term") != _WHOLE).select(
        "term", "df", n_docs.alias("n_docs"), (total / n_docs).alias("avg_dl")
    )


def scored(terms: DataFrame, stats: DataFrame, index: DataFrame) -> DataFrame:
    """BM25 score of every matching document: ``(query_id, doc_id, score)``.

    ``terms`` is ``query_terms``, ``stats`` the term statistics and ``index`` the postings. The
    weighted query terms are small and their size is known, so the postings stay where they are and
    each task sums the scores of its own documents.
    """
    idf = F.log(F.lit(1.0) + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = terms.join(stats, "term").select("query_id", "term", idf.alias("idf"), "avg_dl")
    weighted = small_side(weighted, "weighted-terms")
    length = F.lit(1 - C.BM25_B) + F.lit(C.BM25_B) * F.col("dl") / F.col("avg_dl")
    gain = F.col("idf") * F.col("tf") * F.lit(C.BM25_K1 + 1) / (F.col("tf") + F.lit(C.BM25_K1) * length)
    return index.join(weighted, "term").groupBy("query_id", "doc_id").agg(
        F.round(F.sum(gain), C.SCORE_DIGITS).alias("score")
    )


def match(queries: DataFrame, docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """``scored`` straight from the documents, without a stored index.

    ``terms`` may pass the written query terms on.
    """
    if terms is None:
        terms = stage(query_terms(queries), "query-terms")
    wanted = wanted_terms(terms)
    return scored(terms, corpus_term_stats(docs, wanted), postings(docs, wanted))


def first_page(scores: DataFrame, queries: DataFrame) -> DataFrame:
    """Best ``k`` documents per query with their ordinal ``rank``; ties go to the lower id."""
    k_max = queries.agg(F.max("k")).first()[0] or 0
    best = skew.top_k(scores, "query_id", [F.col("score").desc(), F.col("doc_id")], int(k_max))
    return best.join(queries.select("query_id", "k"), "query_id").where(F.col("rank") <= F.col("k")).drop("k")


def page(queries: DataFrame, docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """``first_page`` straight from the documents: ``(query_id, doc_id, score, rank)``.

    Texts are read and tokenised once: a first pass keeps, for each document, how often it holds each term
    of the queries. Document frequencies come from this table, and a second pass over it scores a batch of
    documents against all queries as a matrix. A document is one row, so nothing is shuffled but the best
    ``k`` of every query and task; pairs of queries and documents are never rows. More than ``MAX_QUERIES``
    queries are searched in blocks, one after another, with the same answers.
    """
    return paged(queries, docs.schema["doc_id"].dataType, lambda asked, k, schema: _block_page(asked, docs, k, schema), terms)


def paged(queries: DataFrame, id_type: T.DataType, search, terms: DataFrame | None = None) -> DataFrame:
    """Best documents of all queries, block after block of queries.

    ``search(asked, k, schema)`` gives candidates ``(query_id, doc_id, score)`` of the ``(query_id, term)``
    rows of one block, among them the best ``k`` of each of its queries.
    """
    if terms is None:
        terms = stage(query_terms(queries), "query-terms")
    k = int(queries.agg(F.max("k")).first()[0] or 0)
    schema = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("doc_id", id_type),
        T.StructField("score", T.DoubleType()),
    ])
    best = None
    for asked in _query_blocks(queries, terms):
        found = search(asked, k, schema)
        best = found if best is None else best.unionByName(found)
    best = skew.top_k(best, "query_id", [F.col("score").desc(), F.col("doc_id")], k)
    return best.join(queries.select("query_id", "k"), "query_id").where(F.col("rank") <= F.col("k")).drop("k")


def _query_blocks(queries: DataFrame, terms: DataFrame) -> Iterator[pa.Table]:
    """Terms of at most about ``MAX_QUERIES`` queries after another."""
    blocks = max(1, math.ceil(queries.count() / MAX_QUERIES))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    for number in range(blocks):
        yield terms.where(block == number).select("query_id", "term").toArrow()


def _block_page(asked: pa.Table, docs: DataFrame, k: int, schema: T.StructType) -> DataFrame:
    """Candidates of the queries in ``asked``, the best ``k`` of each task."""
    spark = docs.sparkSession
    words = pc.unique(asked["term"])
    if not len(words) or k == 0:
        return spark.createDataFrame([], schema)
    counted = stage(_counted_terms(docs, words), "counted-terms")
    totals_ = counted.agg(F.count(F.lit(1)).alias("n"), F.sum("dl").alias("dl")).first()
    # At most one row per term that was sent.
    df = counted.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()
    frequency = np.zeros(len(words))
    frequency[df["t"].to_numpy()] = df["count"].to_numpy()
    idf = weights(frequency, totals_["n"])
    average = (totals_["dl"] or 0) / max(1, totals_["n"])
    return best_documents(counted, *places(asked, words), idf, average, k, schema)


def weights(frequency: np.ndarray, n_docs: int) -> np.ndarray:
    """Inverse document frequency of terms that ``frequency`` of ``n_docs`` documents hold."""
    return np.log(1.0 + (n_docs - frequency + 0.5) / (frequency + 0.5))


def places(asked: pa.Table, words: pa.Array) -> tuple[pa.Array, list[np.ndarray]]:
    """Queries of ``(query_id, term)`` rows, and for each of ``words`` the places of the queries that hold it."""
    query_ids = pc.unique(asked["query_id"])
    term_of = pc.index_in(asked["term"], value_set=words).to_numpy()
    place_of = pc.index_in(asked["query_id"], value_set=query_ids).to_numpy()
    order = np.argsort(term_of, kind="stable")
    return query_ids, np.split(place_of[order], np.cumsum(np.bincount(term_of, minlength=len(words)))[:-1])


def best_documents(
    counted: DataFrame, query_ids: pa.Array, of_term: list[np.ndarray], idf: np.ndarray, average: float,
    k: int, schema: T.StructType,
) -> DataFrame:
    """Best ``k`` of each task and query among ``counted`` documents ``(doc_id, dl, terms, tfs)``."""
    shared = counted.sparkSession.sparkContext.broadcast((query_ids.to_pandas().to_numpy(), idf, of_term))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, weight, places_ = shared.value
        step, best = max(1, MAX_CELLS // len(ids)), None
        for batch in batches:
            # Ties go to the lower id, which comes first.
            batch = batch.take(pc.sort_indices(batch.column("doc_id")))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                scores = _scores(part, weight, places_, len(ids), average)
                q, d = _best_columns(scores, k)
                doc_ids = part.column("doc_id").take(pa.array(d)).to_pandas().to_numpy()
                new = pd.DataFrame({"q": ids[q], "id": doc_ids, "score": scores[q, d]})
                best = new if best is None else keep_best(pd.concat([best, new], ignore_index=True), k)
        if best is not None:
            table = pa.table({"query_id": pa.array(best["q"]), "doc_id": pa.array(best["id"]), "score": pa.array(best["score"])})
            yield from table.to_batches()

    return counted.mapInArrow(run, schema)


def _counted_terms(docs: DataFrame, words: pa.Array) -> DataFrame:
    """``(doc_id, dl, terms, tfs)``: of every document the numbers of its ``words`` and their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in by_terms(batches, "toks"):
            toks = batch.column("toks")
            number = pc.index_in(toks.flatten(), value_set=wanted)
            row = np.repeat(np.arange(len(toks)), pc.list_value_length(toks).to_numpy())
            known = number.is_valid().to_numpy(zero_copy_only=False)
            pairs, tf = np.unique(row[known] * len(wanted) + number.filter(pa.array(known)).to_numpy(), return_counts=True)
            offsets = pa.array(np.searchsorted(pairs // len(wanted), np.arange(len(toks) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32))) for v in (pairs % len(wanted), tf)]
            yield pa.record_batch([batch.column("doc_id"), batch.column("dl"), *lists], ["doc_id", "dl", "terms", "tfs"])

    rows = tokenized(docs).select("doc_id", "dl", F.coalesce("toks", F.array().cast("array<string>")).alias("toks"))
    schema = T.StructType([
        rows.schema["doc_id"], rows.schema["dl"],
        *[T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("terms", "tfs")],
    ])
    return rows.mapInArrow(run, schema)


def _scores(batch: pa.RecordBatch, idf: np.ndarray, places: list[np.ndarray], n_queries: int, average: float) -> np.ndarray:
    """BM25 of each query (row) for each document (column), rounded; -1 where they share no term."""
    dl = batch.column("dl").to_numpy()
    sizes = pc.list_value_length(batch.column("terms")).to_numpy()
    doc = np.repeat(np.arange(len(dl)), sizes)
    term, tf = batch.column("terms").flatten().to_numpy(), batch.column("tfs").flatten().to_numpy()
    length = (1 - C.BM25_B) + C.BM25_B * dl[doc] / average if average else np.ones(len(doc))
    gain = idf[term] * tf * (C.BM25_K1 + 1) / (tf + C.BM25_K1 * length)
    scores = spread_gains(term, doc, gain, places, n_queries, len(dl))
    return np.where(scores > 0, np.round(scores, C.SCORE_DIGITS), -1.0)


def spread_gains(
    term: np.ndarray, column: np.ndarray, gain: np.ndarray, places: list[np.ndarray], n_queries: int, n_columns: int
) -> np.ndarray:
    """Matrix of queries by columns: the gains of each column's terms, summed for the queries that hold them."""
    sums = np.zeros((n_queries, n_columns))
    order = np.argsort(term, kind="stable")
    bounds = np.nonzero(np.diff(term[order]))[0] + 1
    for rows in np.split(order, bounds) if len(order) else []:
        sums[np.ix_(places[term[rows[0]]], column[rows])] += gain[rows]
    return sums


def _best_columns(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` best matches of each row; of equal ones the first."""
    keep = scores >= 0
    if scores.shape[1] > k:
        kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k, None]
        above, level = scores > kth, scores == kth
        keep &= above | (level & (np.cumsum(level, axis=1) <= k - above.sum(axis=1, keepdims=True)))
    return np.nonzero(keep)


def totals(scores: DataFrame, queries: DataFrame) -> DataFrame:
    """Matching documents per query before the page is cut; 0 where nothing matches."""
    counted = scores.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    return queries.select("query_id").join(counted, "query_id", "left").select(
        "query_id", F.coalesce("n", F.lit(0)).alias("total_size")
    )


def matching(queries: DataFrame, docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Number of matching documents per query, without scores: ``totals`` straight from the documents.

    Each task counts the queries its documents match; one row per query and task is shuffled.
    """
    return matched(queries, lambda words: _counted_terms(docs, words), terms)


def matched(queries: DataFrame, counted, terms: DataFrame | None = None) -> DataFrame:
    """``matching`` over the documents ``counted(words)`` gives for the terms of a block of queries."""
    if terms is None:
        terms = stage(query_terms(queries), "query-terms")
    schema = T.StructType([T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField("n", T.LongType())])
    found = None
    for asked in _query_blocks(queries, terms):
        words = pc.unique(asked["term"])
        if len(words):
            part = _block_matches(counted(words), *places(asked, words), schema)
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = queries.sparkSession.createDataFrame([], schema)
    summed = found.groupBy("query_id").agg(F.sum("n").alias("n"))
    return queries.select("query_id").join(summed, "query_id", "left").select(
        "query_id", F.coalesce("n", F.lit(0)).alias("total_size")
    )


def _block_matches(counted: DataFrame, query_ids: pa.Array, of_term: list[np.ndarray], schema: T.StructType) -> DataFrame:
    shared = counted.sparkSession.sparkContext.broadcast((query_ids, of_term))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, places_ = shared.value
        n, step = np.zeros(len(ids), dtype=np.int64), max(1, MAX_CELLS // len(ids))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                terms = batch.column("terms").slice(start, step)
                doc = np.repeat(np.arange(len(terms)), pc.list_value_length(terms).to_numpy())
                term = terms.flatten().to_numpy()
                n += (spread_gains(term, doc, np.ones(len(term)), places_, len(ids), len(terms)) > 0).sum(axis=1)
        yield pa.record_batch([ids, pa.array(n)], ["query_id", "n"])

    return counted.mapInArrow(run, schema)


def snippets(page: DataFrame, terms: DataFrame, docs: DataFrame) -> DataFrame:
    """Add ``title, link, snippet`` to the hits: the text from the first query term on, cut to size.

    ``page`` holds one page per query; it is written first, so that it goes to the texts and the
    texts are not shuffled.
    """
    wanted = terms.groupBy("query_id").agg(F.array_join(F.array_sort(F.collect_set("term")), "|").alias("_terms"))
    hits = small_side(page.join(wanted, "query_id"), "hits")
    # Terms are letters and digits, so their alternation finds the first of them in one pass.
    at = F.greatest(F.regexp_instr(F.lower(F.col("text")), F.col("_terms")), F.lit(1))
    cut = F.substring(F.col("text"), at, F.lit(C.SNIPPET_CHARS)).alias("snippet")
    return docs.join(hits, "doc_id").select(*page.columns, "title", "link", cut)


def upsert_index(index: DataFrame, changed: DataFrame) -> DataFrame:
    """Postings after an incremental import: changed documents are replaced, none is deleted.

    Only the changed documents are tokenised.
    """
    ids = small_side(changed.select("doc_id"), "changed")
    kept = index.join(ids, "doc_id", "left_anti")
    return kept.unionByName(postings(changed))
