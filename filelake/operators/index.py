"""Stored text index: immutable segments of document blocks, ended documents, merging, and search that skips blocks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filelake import constants as C
from filelake import schemas
from filelake.functions import text as X
from filelake.operators import skew, text
from filelake.operators.vectors import keep_best
from filelake.session import dropping_staged, remove, small_batches, small_side, spread, stage
from filelake.sources.state import StateTable

# A block's number holds its segment, the task that wrote it and its place there: 2^21 of each.
_BITS = 21
# Columns that hold the documents of a block.
_POSTINGS = ("terms", "docs", "doc_terms", "doc_tfs")
# Blocks with the highest bounds that are searched first for every query, beyond those that hold k documents.
SEED_BLOCKS = 4
# Terms of documents that a task of a large import gathers, to put documents of similar length in one block.
GATHERED_TERMS = 1_000_000
# Bytes of a row group of blocks: what a task that writes or reads them holds at once.
GROUP_BYTES = 8 * 1024**2
# Versions after which the ended documents are written together again.
GONE_VERSIONS = 16


@dataclass(frozen=True)
class IndexJob:
    """Keeps an inverted index of documents below ``root`` and answers BM25 searches from it.

    An import writes one segment with the documents it brings and a list of the places where older segments
    hold earlier versions of them; nothing stored is rewritten. Segments whose sizes come close are merged, so
    there are about as many as the logarithm of the number of documents. The manifest of live segments is
    written last: an import that broke off has done nothing, and a repeated one replaces its own documents.

    A segment is a table of blocks of ``block_docs`` documents of similar length. A block has its terms with
    the highest count and the shortest length among their documents, which bound every score from above under
    any corpus statistics. ``doc_terms`` and ``doc_tfs`` are the ``n`` terms of each document, as numbers in the
    block's, and their counts: unsigned integers of as few bytes as the largest of the block needs. Statistics add up over segments, less those of the ended documents.
    """

    spark: SparkSession
    root: str
    id_type: str = "bigint"
    block_docs: int = 64

    # --- state ---------------------------------------------------------------------------------

    @property
    def manifest(self) -> StateTable:
        return StateTable(self.spark, f"{self.root}/manifest", "segment", schemas.SEGMENT)

    def segments(self) -> list[Row]:
        """Live segments, oldest first: about as many as the logarithm of the documents."""
        return sorted(self.manifest.read().collect(), key=lambda s: s.segment)

    def _next(self) -> int:
        return max((v for v, _ in self.manifest.versions()), default=-1) + 1

    @property
    def _document(self) -> T.StructType:
        return T.StructType.fromDDL(f"doc_id {self.id_type}, dl bigint, terms array<string>, tfs array<int>")

    @property
    def _block(self) -> T.StructType:
        return T.StructType.fromDDL(
            "segment bigint, block bigint, terms array<string>, df array<int>, max_tf array<int>, min_dl array<bigint>, "
            f"docs array<struct<doc_id: {self.id_type}, dl: bigint, n: int>>, doc_terms binary, doc_tfs binary"
        )

    @property
    def _ended(self) -> T.StructType:
        return T.StructType.fromDDL(f"segment bigint, block bigint, place int, doc_id {self.id_type}, dl bigint, terms array<string>")

    def _blocks(self, live: list[Row]) -> DataFrame:
        paths = [f"{self.root}/segment-{s.segment}" for s in live]
        return self.spark.read.schema(self._block).parquet(*paths) if paths else self.spark.createDataFrame([], self._block)

    def _gone(self, live: list[Row], version: int) -> DataFrame:
        """Ended documents of the live segments, as of the last ``version``."""
        first = min((s.gone_from for s in live), default=version + 1)
        if not any(s.n_gone for s in live):
            return self.spark.createDataFrame([], self._ended)
        paths = [f"{self.root}/gone-{v}" for v in range(first, version + 1)]
        rows = self.spark.read.schema(self._ended).parquet(*paths)
        return rows.where(F.col("segment").isin([s.segment for s in live]))

    def _with_gone(self, blocks: DataFrame, live: list[Row]) -> DataFrame:
        """Blocks with the ``gone`` places in them."""
        if not any(s.n_gone for s in live):
            return blocks.withColumn("gone", F.lit(None).cast("array<int>"))
        gone = self._gone(live, self._next() - 1).groupBy("block").agg(F.collect_set("place").alias("gone"))
        return blocks.join(small_side(gone, "gone-places"), "block", "left")

    # --- import --------------------------------------------------------------------------------

    def run(self, changed: DataFrame, removed: DataFrame | None = None) -> None:
        """Take in ``changed`` ``(doc_id, text)`` and take out ``removed`` ``(doc_id)``.

        A document that is stored already is replaced; one that is in both tables is stored. A null text
        is an empty document, rows without an id are left out. Of several rows with one id the longest
        counts. Only what the import brings is tokenised.
        """
        live, version = self.segments(), self._next()
        with dropping_staged(self.spark), small_batches(self.spark):
            fresh = self._take_in(version, changed)
            ids = fresh.select(F.explode("docs.doc_id").alias("doc_id"))
            if removed is not None:
                ids = ids.unionByName(removed.select(F.col("doc_id").cast(self.id_type).alias("doc_id"))).distinct()
            places = self._places(live, version, ids)
            first = min((s.gone_from for s in live), default=version)
            if version - first >= GONE_VERSIONS:
                # Written together with all older ones, which are then no longer read.
                ended, first = stage(places, "ended"), version
                ended.unionByName(self._gone(live, version - 1)).write.mode("overwrite").parquet(f"{self.root}/gone-{version}")
            else:
                places.write.mode("overwrite").parquet(f"{self.root}/gone-{version}")
                ended = self.spark.read.schema(self._ended).parquet(f"{self.root}/gone-{version}")
            counted = ended.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.sum("dl").alias("dl"))
            lost = {r.segment: (r.n, r.dl) for r in counted.collect()}
            n, dl = fresh.select(F.explode("docs.dl").alias("dl")).agg(F.count(F.lit(1)), F.coalesce(F.sum("dl"), F.lit(0))).first()
            entries = [
                {**s.asDict(), "n_gone": s.n_gone + lost.get(s.segment, (0, 0))[0], "gone_dl": s.gone_dl + lost.get(s.segment, (0, 0))[1]}
                for s in live
            ]
            if n:
                entries.append({"segment": version, "n_docs": n, "sum_dl": dl, "n_gone": 0, "gone_dl": 0})
            self._commit(version, entries, first)
        self._merge()

    def _take_in(self, segment: int, changed: DataFrame) -> DataFrame:
        """Write the documents ``changed`` as a segment; its blocks."""
        rows = changed.where(F.col("doc_id").isNotNull()).select(
            F.col("doc_id").cast(self.id_type).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
        )
        rows, small = spread(rows, "doc_id")
        rows = rows.select("doc_id", X.plain(F.col("text")).alias("text"))
        most = GATHERED_TERMS
        if small:
            self._write(segment, stage(rows.mapInArrow(lambda batches: _counts(_split(batches)), self._document), "import"))
        else:
            make = self._blocks_of(segment)
            self._store(segment, rows.mapInArrow(lambda batches: make(_by_length(_counts(_split(batches)), most)), self._block))
        fresh = self._segment(segment)
        repeated = fresh.select(F.explode("docs.doc_id").alias("doc_id")).groupBy("doc_id").count().where(F.col("count") > 1)
        if not repeated.isEmpty():
            docs = self._documents(fresh.withColumn("gone", F.lit(None).cast("array<int>")))
            self._write(segment, stage(skew.latest(docs, "doc_id", [F.col("dl").desc(), F.col("terms").desc(), F.col("tfs").desc()]), "import"))
            fresh = self._segment(segment)
        return fresh

    def _places(self, live: list[Row], version: int, ids: DataFrame) -> DataFrame:
        """Where live segments hold the documents ``ids``, with their lengths and terms."""
        if not live:
            return self.spark.createDataFrame([], self._ended)
        blocks = self._blocks(live)
        at = blocks.select("block", F.posexplode("docs.doc_id").alias("place", "doc_id"))
        at = at.join(small_side(ids, "changed"), "doc_id", "left_semi")
        at = at.join(self._gone(live, version - 1).select("block", "place"), ["block", "place"], "left_anti")
        at = at.groupBy("block").agg(F.collect_set("place").alias("at"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _by_postings(batches):
                doc_ids, dl, sizes, at, _, doc = _flat(batch, batch.column("at"), False)
                n = pc.list_value_length(batch.column("docs")).to_numpy()
                row = np.repeat(np.arange(len(n)), n)[doc]
                of_row = pa.array(row)
                columns = [batch.column("segment").take(of_row), batch.column("block").take(of_row),
                           pa.array((doc - (np.cumsum(n) - n)[row]).astype(np.int32)), doc_ids, pa.array(dl), _terms_of(batch, sizes, at)]
                yield pa.record_batch(columns, ["segment", "block", "place", "doc_id", "dl", "terms"])

        found = blocks.join(small_side(at, "places"), "block").select("segment", "block", "at", *_POSTINGS)
        return found.mapInArrow(run, self._ended)

    def _blocks_of(self, segment: int):
        """Function of a task that makes blocks of ordered documents ``(doc_id, dl, terms, tfs)``."""
        size, arrow = self.block_docs, _arrow_type(self.spark, self._block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = (segment << 2 * _BITS) + (TaskContext.get().partitionId() << _BITS)
            for batch in batches:
                for start in range(0, batch.num_rows, size):
                    yield _block_of(batch.slice(start, size), segment, number, arrow)
                    number += 1
                # Not held while the next documents are gathered.
                del batch
                pa.default_memory_pool().release_unused()

        return run

    def _write(self, segment: int, docs: DataFrame) -> None:
        """Blocks of ``docs``; documents of similar length share one, which keeps its bounds tight."""
        ordered = docs.repartitionByRange("dl", "doc_id").sortWithinPartitions("dl", "doc_id")
        self._store(segment, ordered.mapInArrow(self._blocks_of(segment), self._block))

    def _store(self, segment: int, blocks: DataFrame, mode: str = "overwrite") -> None:
        """Add ``blocks`` to the folder of a segment, or make it of them.

        A block may have a few hundred kilobytes, and readers decode thousands of rows at once, but of one row group only.
        """
        blocks.write.option("parquet.block.size", GROUP_BYTES).mode(mode).parquet(f"{self.root}/segment-{segment}")

    def _segment(self, segment: int) -> DataFrame:
        return self.spark.read.schema(self._block).parquet(f"{self.root}/segment-{segment}")

    def _commit(self, version: int, entries: list[dict], gone_from: int) -> None:
        kept = [{**e, "gone_from": gone_from} for e in entries if e["n_gone"] < e["n_docs"]]
        names = schemas.SEGMENT.fieldNames()
        rows = self.spark.createDataFrame([tuple(e[n] for n in names) for e in kept], schemas.SEGMENT)
        self.manifest.write(version, rows.coalesce(1), full=True)
        self._forget(version)

    def _forget(self, version: int) -> None:
        """Remove folders that neither this version nor the one before it reads."""
        keep = self.manifest.read(version).collect() + self.manifest.read(version - 1).collect()
        segments, first = {s.segment for s in keep}, min((s.gone_from for s in keep), default=version)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        for found in fs.listStatus(path):
            kind, _, number = found.getPath().getName().partition("-")
            if (kind == "segment" and int(number) not in segments) or (kind == "gone" and int(number) < first):
                remove(self.spark, found.getPath().toString())
        self.manifest.compact()

    # --- merging -------------------------------------------------------------------------------

    def _merge(self) -> None:
        """One segment instead of the newest ones, as long as the next is no larger than all after it, and of hollow ones."""
        live, version = self.segments(), self._next()
        left = {s.segment: s.n_docs - s.n_gone for s in live}
        run, total = [], 0
        for s in reversed(live):
            if run and left[s.segment] > total:
                break
            run.append(s)
            total += left[s.segment]
        hollow = [s for s in live if 2 * s.n_gone > s.n_docs]
        if len(run) < 2:
            run = []
        chosen = run + [s for s in hollow if s not in run]
        if not chosen:
            return
        with dropping_staged(self.spark), small_batches(self.spark):
            blocks = self._with_gone(self._blocks(chosen), chosen)
            n, longest, shortest = F.size("docs"), F.array_max("docs.dl"), F.array_min("docs.dl")
            whole = F.col("gone").isNull() & (2 * n >= self.block_docs) & (longest <= 2 * shortest + 16)
            alive = F.col("gone").isNull() | (F.size("gone") < n)
            self._write(version, stage(self._documents(blocks.where(~whole & alive)), "merged"))
            # Numbers of the upper half of the tasks, which the blocks just made leave free.
            place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
            number = F.shiftleft(F.spark_partition_id().cast("bigint") + (1 << _BITS - 1), _BITS) + place
            copied = blocks.where(whole).withColumn("segment", F.lit(version).cast("bigint")).withColumn("block", F.lit(version << 2 * _BITS) + number)
            self._store(version, copied.select(*self._block.fieldNames()), "append")
            # Nothing has ended since; the folder keeps versions without a gap.
            self.spark.createDataFrame([], self._ended).write.mode("overwrite").parquet(f"{self.root}/gone-{version}")
            entries = [s.asDict() for s in live if s not in chosen]
            entries.append({
                "segment": version, "n_docs": sum(left[s.segment] for s in chosen),
                "sum_dl": sum(s.sum_dl - s.gone_dl for s in chosen), "n_gone": 0, "gone_dl": 0,
            })
            first = min(s.gone_from for s in live) if len(entries) > 1 else version
            self._commit(version, entries, first)

    def _documents(self, blocks: DataFrame) -> DataFrame:
        """Documents of ``blocks`` with ``gone`` places, as an import counts them."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _by_postings(batches):
                ids, dl, sizes, at, tf, _ = _flat(batch, batch.column("gone"))
                terms = _terms_of(batch, sizes, at)
                tfs = pa.ListArray.from_arrays(_offsets(sizes), pa.array(tf.astype(np.int32)))
                yield pa.record_batch([ids, pa.array(dl), terms, tfs], ["doc_id", "dl", "terms", "tfs"])

        return blocks.select("gone", *_POSTINGS).mapInArrow(run, self._document)

    # --- search --------------------------------------------------------------------------------

    def page(self, queries: DataFrame, terms: DataFrame | None = None) -> DataFrame:
        """Best ``k`` documents of ``(query_id, text, k)``: ``(query_id, doc_id, score, rank)``, as ``text.page``.

        The blocks with the highest bounds are scored first. What is then the kth score of a query is a floor
        that every block without a higher bound for any query is skipped by; blocks are never skipped otherwise,
        so the answer is exact. Blocks that are left out are not decoded, and a block of queries shares its scan.
        """
        live = self.segments()

        def search(asked: pa.Table, k: int, schema: T.StructType) -> DataFrame:
            found = self._needed(live, asked, k, schema)
            if found is None:
                return self.spark.createDataFrame([], schema)
            needed, ask = found
            return self._best(live, needed, ask, k, schema)

        # What is looked up before the last scan, which runs with the plan that is returned.
        with small_batches(self.spark):
            return text.paged(queries, self._document["doc_id"].dataType, search, terms)

    def matching(self, queries: DataFrame, terms: DataFrame | None = None) -> DataFrame:
        """Number of matching documents per query, as ``text.matching``."""
        live = self.segments()
        with small_batches(self.spark):
            blocks = self._with_gone(self._blocks(live), live)
            # A row for each query.
            return stage(text.matched(queries, lambda words: self._counted(blocks, words), terms), "matching")

    def needed_blocks(self, queries: DataFrame) -> DataFrame:
        """``(block)``: those that a search for few enough queries for one block of them scores."""
        asked = text.query_terms(queries).select("query_id", "term").toArrow()
        k = int(queries.agg(F.max("k")).first()[0] or 0)
        schema = T.StructType([
            queries.schema["query_id"], self._document["doc_id"], T.StructField("score", T.DoubleType()),
        ])
        found = self._needed(self.segments(), asked, k, schema)
        return found[0] if found else self.spark.createDataFrame([], "block bigint")

    def _needed(self, live: list[Row], asked: pa.Table, k: int, schema: T.StructType):
        words = pc.unique(asked["term"])
        n = sum(s.n_docs - s.n_gone for s in live)
        if not n or not len(words) or k == 0:
            return None
        average = sum(s.sum_dl - s.gone_dl for s in live) / n
        headers = self._headers(live, words)
        idf = text.weights(self._frequency(live, words, headers), n)
        ask = (words, *text.places(asked, words), idf, average)

        # For every query the blocks that promise most, and the kth score in them.
        seeds = headers.mapInArrow(_seeds(ask, SEED_BLOCKS + k // self.block_docs, self.spark), "q int, block bigint, bound double")
        seeds = skew.top_k(seeds, "q", [F.col("bound").desc(), F.col("block")], SEED_BLOCKS + k // self.block_docs)
        first = self._best(live, seeds.select("block").distinct(), ask, k, schema)
        first = skew.top_k(first, "query_id", [F.col("score").desc(), F.col("doc_id")], k)
        # At most one row per query of the block.
        floors = first.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k).toArrow()
        floor = np.zeros(len(ask[1]))
        if floors.num_rows:
            floor[pc.index_in(floors["query_id"], value_set=ask[1]).to_numpy()] = floors["floor"].to_numpy()
        return headers.mapInArrow(_above(ask, floor, self.spark), "block bigint"), ask

    def _best(self, live: list[Row], needed: DataFrame, ask: tuple, k: int, schema: T.StructType) -> DataFrame:
        words, ids, of_term, idf, average = ask
        blocks = self._blocks(live).join(small_side(needed, "needed-blocks"), "block", "left_semi")
        return text.best_documents(self._counted(self._with_gone(blocks, live), words), ids, of_term, idf, average, k, schema)

    def _headers(self, live: list[Row], words: pa.Array) -> DataFrame:
        """``(block, at, df, max_tf, min_dl)``: of each block what it says of ``words``, whose numbers are ``at``."""
        shared = self.spark.sparkContext.broadcast(words)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in text.by_terms(batches, "terms"):
                at = pc.index_in(batch.column("terms").flatten(), value_set=shared.value)
                known = at.is_valid()
                row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column("terms")).to_numpy())
                offsets = _offsets(np.bincount(row[known.to_numpy(zero_copy_only=False)], minlength=batch.num_rows))
                lists = [at, *(batch.column(c).flatten() for c in ("df", "max_tf", "min_dl"))]
                lists = [pa.ListArray.from_arrays(offsets, v.filter(known)) for v in lists]
                yield pa.record_batch([batch.column("block"), *lists], ["block", "at", "df", "max_tf", "min_dl"])

        rows = self._blocks(live).select("block", "terms", "df", "max_tf", "min_dl")
        # Read for the frequencies and for the bounds, twice.
        return stage(rows.mapInArrow(run, "block bigint, at array<int>, df array<int>, max_tf array<int>, min_dl array<bigint>"), "headers")

    def _frequency(self, live: list[Row], words: pa.Array, headers: DataFrame) -> np.ndarray:
        """Live documents that hold each of ``words``: sums of the segments less the ended documents."""
        shared = self.spark.sparkContext.broadcast(words)

        def summed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.RecordBatch]:
            n = None
            for at, df in batches:
                found = np.bincount(at.to_numpy(), df.to_numpy(), minlength=len(shared.value)).astype(np.int64)
                n = found if n is None else n + found
            if n is not None:
                at = np.flatnonzero(n)
                yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(n[at])], ["t", "n"])

        def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from summed((b.column("at").flatten(), b.column("df").flatten()) for b in batches)

        def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = (pc.index_in(b.column("terms").flatten(), value_set=shared.value).drop_null() for b in text.by_terms(batches, "terms"))
            yield from summed((at, pa.array(np.ones(len(at)))) for at in found)

        rows = headers.select("at", "df").mapInArrow(stored, "t int, n bigint")
        if any(s.n_gone for s in live):
            gone = self._gone(live, self._next() - 1).select("terms")
            rows = rows.unionByName(gone.mapInArrow(ended, "t int, n bigint").select("t", (-F.col("n")).alias("n")))
        # At most one row per term that was sent.
        total = rows.groupBy("t").agg(F.sum("n").alias("n")).toArrow()
        frequency = np.zeros(len(words))
        frequency[total["t"].to_numpy()] = total["n"].to_numpy()
        return frequency

    def _counted(self, blocks: DataFrame, words: pa.Array) -> DataFrame:
        """``(doc_id, dl, terms, tfs)`` of the blocks' live documents: the numbers of ``words`` and their counts."""
        shared = self.spark.sparkContext.broadcast(words)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _by_postings(batches):
                ids, dl, sizes, at, tf, _ = _flat(batch, batch.column("gone"))
                number = pc.fill_null(pc.index_in(batch.column("terms").flatten(), value_set=shared.value), -1).to_numpy()[at]
                doc, known = np.repeat(np.arange(len(dl)), sizes), number >= 0
                offsets = pa.array(np.append(0, np.cumsum(np.bincount(doc[known], minlength=len(dl)))).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(v[known].astype(np.int32))) for v in (number, tf)]
                yield pa.record_batch([ids, pa.array(dl), *lists], ["doc_id", "dl", "terms", "tfs"])

        schema = T.StructType.fromDDL(f"doc_id {self.id_type}, dl bigint, terms array<int>, tfs array<int>")
        return blocks.select("gone", *_POSTINGS).mapInArrow(run, schema)


def _arrow_type(spark: SparkSession, schema: T.StructType) -> pa.Schema:
    return spark.createDataFrame([], schema).toArrow().schema


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Plain ``(doc_id, text)`` to ``(doc_id, dl, toks)``."""
    for batch in batches:
        for part in text.parts(batch, pc.binary_length(batch.column("text")).to_numpy(), text.MAX_TEXT):
            toks = text.split_terms(part.column("text"))
            dl = pc.list_value_length(toks).cast(pa.int64())
            yield pa.record_batch([part.column("doc_id"), dl, toks], ["doc_id", "dl", "toks"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(doc_id, dl, toks)`` to ``(doc_id, dl, terms, tfs)``: each term of a document once, with its count."""
    for batch in text.by_terms(batches, "toks"):
        toks = batch.column("toks")
        coded = toks.flatten().dictionary_encode()
        row = np.repeat(np.arange(len(toks)), pc.list_value_length(toks).to_numpy())
        width = max(1, len(coded.dictionary))
        pairs, tf = np.unique(row * width + coded.indices.to_numpy(), return_counts=True)
        offsets = pa.array(np.searchsorted(pairs // width, np.arange(len(toks) + 1)).astype(np.int32))
        terms = coded.dictionary.take(pa.array(pairs % width))
        lists = [pa.ListArray.from_arrays(offsets, v) for v in (terms, pa.array(tf.astype(np.int32)))]
        yield pa.record_batch([batch.column("doc_id"), batch.column("dl"), *lists], ["doc_id", "dl", "terms", "tfs"])


def _by_length(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Documents in the order of their lengths, gathered until they hold ``most`` terms."""
    held, n = [], 0

    def ordered() -> pa.RecordBatch:
        docs = pa.concat_batches(held)
        held.clear()
        return docs.take(pc.sort_indices(docs, sort_keys=[("dl", "ascending"), ("doc_id", "ascending")]))

    for batch in batches:
        held.append(batch)
        n += len(batch.column("tfs").flatten())
        if n >= most:
            del batch
            yield ordered()
            n = 0
    if held:
        yield ordered()


def _block_of(docs: pa.RecordBatch, segment: int, number: int, schema: pa.Schema) -> pa.RecordBatch:
    """One block row of some documents ``(doc_id, dl, terms, tfs)``."""
    coded = docs.column("terms").flatten().dictionary_encode()
    code, tf = coded.indices.to_numpy(), docs.column("tfs").flatten().to_numpy()
    sizes, dl = pc.list_value_length(docs.column("terms")).to_numpy(), docs.column("dl").to_numpy()
    n = len(coded.dictionary)
    max_tf, min_dl = np.zeros(n, np.int32), np.full(n, np.iinfo(np.int64).max)
    np.maximum.at(max_tf, code, tf)
    np.minimum.at(min_dl, code, np.repeat(dl, sizes))
    listed = pa.StructArray.from_arrays([docs.column("doc_id"), pa.array(dl), pa.array(sizes)], ["doc_id", "dl", "n"])

    def one(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    df = np.bincount(code, minlength=n).astype(np.int32)
    columns = [pa.array([segment], pa.int64()), pa.array([number], pa.int64()),
               *(one(v) for v in (coded.dictionary, pa.array(df), pa.array(max_tf), pa.array(min_dl), listed)),
               *(pa.array([_packed(v)], pa.binary()) for v in (code, tf))]
    return pa.record_batch([c.cast(f.type) for c, f in zip(columns, schema)], schema.names)


def _packed(values: np.ndarray) -> bytes:
    width = np.min_scalar_type(int(values.max(initial=0))).itemsize
    return values.astype(f"<u{width}").tobytes()


def _unpacked(packed: pa.Array, n: np.ndarray) -> np.ndarray:
    """Values of ``_packed`` arrays of ``n`` values, one after another."""
    buffers = [(b.as_buffer(), k) for b, k in zip(packed, n) if k]
    return np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(b, f"<u{b.size // k}") for b, k in buffers)]).astype(np.int64)


def _by_postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in parts by the number of terms that their documents hold."""
    for batch in batches:
        lists = batch.column("docs")
        ends = np.append(0, np.cumsum(lists.flatten().field("n").to_numpy(), dtype=np.int64))
        places = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))
        yield from text.parts(batch, np.diff(ends[places]))


def _terms_of(batch: pa.RecordBatch, sizes: np.ndarray, at: np.ndarray) -> pa.ListArray:
    """Lists of ``sizes`` terms, by their places in the flattened terms of a batch of blocks."""
    return pa.ListArray.from_arrays(_offsets(sizes), batch.column("terms").flatten().take(pa.array(at)))


def _flat(batch: pa.RecordBatch, places: pa.Array, left: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents of a batch of blocks that are not at ``places``, or those that are: ids, lengths and numbers of terms;
    of each of their terms, one after another, the place in the batch's flattened terms and the count; and the numbers
    of the documents in the batch."""
    lists = batch.column("docs")
    docs = lists.flatten()
    n = pc.list_value_length(lists).to_numpy()
    keep = np.full(len(docs), left)
    listed = pc.fill_null(pc.list_value_length(places), 0).to_numpy()
    keep[np.repeat(np.cumsum(n) - n, listed) + places.flatten().to_numpy()] = not left
    sizes = docs.field("n").to_numpy()
    ends = np.append(0, np.cumsum(sizes, dtype=np.int64))
    held = np.diff(ends[np.append(0, np.cumsum(n))])
    width = pc.list_value_length(batch.column("terms")).to_numpy()
    base = np.repeat(np.cumsum(width) - width, n)
    at = _unpacked(batch.column("doc_terms"), held) + np.repeat(base, sizes)
    used = np.repeat(keep, sizes)
    return (
        docs.field("doc_id").filter(pa.array(keep)), docs.field("dl").to_numpy()[keep], sizes[keep],
        at[used], _unpacked(batch.column("doc_tfs"), held)[used], np.flatnonzero(keep),
    )


def _bounds(batch: pa.RecordBatch, ask: tuple) -> Iterator[tuple[int, np.ndarray]]:
    """Highest score that each query (row) can reach in each block (column), for parts of the batch from a row on."""
    _, ids, of_term, idf, average = ask
    step = max(1, text.MAX_CELLS // len(ids))
    for start in range(0, batch.num_rows, step):
        part = batch.slice(start, step)
        block = np.repeat(np.arange(part.num_rows), pc.list_value_length(part.column("at")).to_numpy())
        term, tf, dl = (part.column(c).flatten().to_numpy() for c in ("at", "max_tf", "min_dl"))
        # A document with a term has a word, so the average is not zero here.
        length = (1 - C.BM25_B) + C.BM25_B * dl / average if average else np.ones(len(dl))
        gain = idf[term] * tf * (C.BM25_K1 + 1) / (tf + C.BM25_K1 * length)
        yield start, text.spread_gains(term, block, gain, of_term, len(ids), part.num_rows)


def _seeds(ask: tuple, most: int, spark: SparkSession):
    shared = spark.sparkContext.broadcast(ask)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in text.by_terms(batches, "at"):
            numbers = batch.column("block").to_numpy()
            for start, bounds in _bounds(batch, shared.value):
                top = np.argpartition(-bounds, min(most, bounds.shape[1]) - 1, axis=1)[:, :most]
                q = np.repeat(np.arange(len(bounds)), top.shape[1])
                new = pd.DataFrame({"q": q, "id": numbers[start + top.ravel()], "score": bounds[q, top.ravel()]})
                new = new[new["score"] > 0]
                best = new if best is None else keep_best(pd.concat([best, new], ignore_index=True), most)
        if best is not None:
            columns = [pa.array(best["q"].to_numpy(np.int32)), pa.array(best["id"].to_numpy()), pa.array(best["score"].to_numpy())]
            yield pa.record_batch(columns, ["q", "block", "bound"])

    return run


def _above(ask: tuple, floor: np.ndarray, spark: SparkSession):
    shared = spark.sparkContext.broadcast((ask, floor))
    # Scores are rounded, and equal ones are told apart by their ids.
    slack = 10.0 ** -C.SCORE_DIGITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask, least = shared.value
        for batch in text.by_terms(batches, "at"):
            for start, bounds in _bounds(batch, ask):
                wanted = ((bounds > 0) & (bounds + slack >= least[:, None])).any(axis=0)
                yield pa.record_batch([batch.column("block").slice(start, len(wanted)).filter(pa.array(wanted))], ["block"])

    return run
