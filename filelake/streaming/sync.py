"""Incremental sync as a Structured Streaming job over a folder of feed files."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filelake import constants as C
from filelake import schemas
from filelake.functions import paths as P
from filelake.operators import imports, replay, skew
from filelake.operators.sync import acceptable, classify, enrich, file_meta, not_failed
from filelake.session import dropping_staged, stage
from filelake.sources import objects
from filelake.sources.state import StateTable
from filelake.streaming import mirror as mirroring

_LIVE = T.StructType([
    T.StructField("path_lower", T.StringType()),
    T.StructField("file_id", T.StringType()),
    T.StructField("rev", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("path_display", T.StringType()),
    T.StructField("server_modified", T.TimestampNTZType()),
    T.StructField("ext", T.StringType()),
    T.StructField("archive", T.BooleanType()),
])
_RETRY = T.StructType([*schemas.CHANGE.fields, T.StructField("attempts", T.LongType())])
_COUNTS = T.StructType([T.StructField("outcome", T.StringType()), T.StructField("n", T.LongType())])
_QUEUE = T.StructType([T.StructField("position", T.LongType()), T.StructField("uri", T.StringType())])
_TOTAL = T.StructType([T.StructField("total", T.LongType())])
_BATCHES = T.StructType([T.StructField("batch", T.LongType()), T.StructField("n", T.LongType())])

# Marks rows that could not be fetched: gets (seq, path_lower, ..., attempts), returns (seq, error).
Fetch = Callable[[DataFrame], DataFrame]
TAKEN = ("synced", "archive")


@dataclass(frozen=True)
class SyncJob:
    """Folds a change feed into state tables below ``root``; paths and ids may mix freely.

    ``paths`` and ``revs`` are what applying the feed event by event leaves behind, and so decide every outcome.
    ``live`` is who owns a path: its last event. A file lives while a path owns it, at the path of its last event, so a
    move keeps it whatever the order of its two events, and the end of its last path ends it.

    With ``mirror`` the job also keeps the objects: new files are copied, archives opened and their members stored,
    a new revision of an archive replaces its members, and what no longer lives is deleted, with a JSON sidecar for
    each. ``fetch`` alone only tells which files could not be read.

    Every micro-batch is one version of each table. The cursor is written last: a batch whose
    cursor is there is done, and a batch that broke off is computed again from the version before
    it and overwrites what it left. So delivery at least once gives each event its effect once.
    """

    spark: SparkSession
    root: str
    fetch: Fetch | None = None
    max_group: int = skew.MAX_GROUP
    # Deltas after which the state tables are folded into a snapshot.
    compact_after: int = 24
    mirror: objects.Mirror | None = None

    @property
    def live(self) -> StateTable:
        """Files by the paths that own them."""
        return StateTable(self.spark, f"{self.root}/live", "path_lower", _LIVE)

    @property
    def paths(self) -> StateTable:
        return StateTable(self.spark, f"{self.root}/paths", "path_lower", schemas.PATH_INDEX)

    @property
    def revs(self) -> StateTable:
        return StateTable(self.spark, f"{self.root}/revs", "file_id", schemas.REV_INDEX)

    @property
    def items(self) -> StateTable:
        """What the mirror holds: sidecars of files, archives and members."""
        return StateTable(self.spark, f"{self.root}/items", "file_id", mirroring.ITEM)

    @property
    def behind(self) -> StateTable:
        """Files whose objects, or archives some of whose members, could not be read yet."""
        return StateTable(self.spark, f"{self.root}/behind", "file_id", mirroring.BEHIND)

    @property
    def queue(self) -> StateTable:
        """Documents to import, numbered in the order of batches and names; a new revision is queued again."""
        return StateTable(self.spark, f"{self.root}/queue", "position", _QUEUE)

    @property
    def queued(self) -> StateTable:
        """How many documents were queued so far."""
        return StateTable(self.spark, f"{self.root}/queued", "total", _TOTAL)

    def import_requests(self, size: int = C.IMPORT_BATCH) -> DataFrame:
        """Import requests ``(batch_id, uris, mode)``, which go on across the micro-batches."""
        return imports.requests(self.queue.read().withColumnRenamed("position", "idx"), size)

    @property
    def retry(self) -> StateTable:
        """Events whose fetch failed; they take part in the next batch again."""
        return StateTable(self.spark, f"{self.root}/retry", "path_lower", _RETRY)

    @property
    def counts(self) -> StateTable:
        return StateTable(self.spark, f"{self.root}/counts", "outcome", _COUNTS)

    @property
    def cursor(self) -> StateTable:
        return StateTable(self.spark, f"{self.root}/cursor", "cursor", schemas.SYNC_STATE)

    @property
    def batches(self) -> StateTable:
        """Events of every batch; the stream's own progress forgets old ones."""
        return StateTable(self.spark, f"{self.root}/batches", "batch", _BATCHES)

    def files(self) -> DataFrame:
        """Live files and archives, each at the path of its last event."""
        return skew.latest(self.live.read(), "file_id", "seq")

    def sidecars(self, mirror: str) -> DataFrame:
        """Sidecars of the live plain files, with their objects below ``mirror``."""
        return file_meta(self.files(), mirror)

    def bootstrap(self, sidecars: DataFrame) -> None:
        """Rebuild lost state from the sidecars of a mirror; nothing happens where there is state.

        Members need no state of their own but what is stored of them. Names and paths are those of the sidecars, so
        the first event of a file after that is judged as if the state had been there.
        """
        if self.revs.versions():
            return
        meta = stage(sidecars.where((F.length("file_id") > 0) & (F.length("rev") > 0)), "bootstrap")
        own = meta.where(F.col("source_zip").isNull()).withColumn("path_lower", F.lower("path"))
        name = F.coalesce("caption", P.basename(F.col("path")))
        live = own.select(
            "path_lower", "file_id", "rev", F.when(F.col("category") != "archive", F.col("category")).alias("category"), "size",
            F.lit(-1).cast("bigint").alias("seq"), name.alias("name"), F.col("path").alias("path_display"),
            F.to_timestamp_ntz("server_modified").alias("server_modified"), P.extension(name).alias("ext"),
            (F.col("category") == "archive").alias("archive"),
        )
        zip_id = F.when(F.col("source_zip").isNotNull(), F.substring_index("file_id", "___", 1))
        self.items.write(-1, meta.withColumn("zip_id", zip_id), full=True)
        self.paths.write(-1, own, full=True)
        self.live.write(-1, live, full=True)
        self.revs.write(-1, own, full=True)

    def run(self, feed: str, max_files: int | None = None) -> list[int]:
        """Process what is new in ``feed`` and stop; the sizes of the batches that ran.

        ``max_files`` bounds a batch and so what a crash can lose. Feed files must be in order.
        """
        before = self.batches.read().agg(F.max("batch")).first()[0]
        before = -1 if before is None else before
        reader = self.spark.readStream.schema(schemas.CHANGE).format("parquet")
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        query = (
            reader.load(feed)
            .writeStream.foreachBatch(self.apply)
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        new = self.batches.read().where(F.col("batch") > before).orderBy("batch")
        return [r["n"] for r in new.where("n > 0").collect()]

    def apply(self, batch: DataFrame, batch_id: int, again: bool = False) -> None:
        """Merge one batch. ``again`` repeats it although its cursor is there."""
        done = self.cursor.versions()
        if done and batch_id <= done[-1][0] and not again:
            return
        # The merge reads the batch several times; the feed files are to be read once.
        batch = batch.persist()
        try:
            with dropping_staged(self.spark):
                self._merge(batch, batch_id)
        finally:
            batch.unpersist()
        # After the cursor: a batch that is computed again must not find a snapshot of itself.
        for table in self._tables():
            table.compact(self.compact_after)

    def _tables(self) -> tuple[StateTable, ...]:
        return (
            self.live, self.paths, self.revs, self.items, self.behind, self.queue, self.queued, self.retry, self.batches,
            self.counts, self.cursor,
        )

    def _merge(self, batch: DataFrame, batch_id: int) -> None:
        before = batch_id - 1
        fetch = self.fetch or (self.mirror.fetch if self.mirror else None)
        events = batch.where(F.col("kind") != "folder").withColumn("attempts", F.lit(0).cast("bigint"))
        if fetch:
            events = stage(events.unionByName(self.retry.read(before)), "events")
        named = events.select("path_lower").distinct()
        # No other path or id can change or matter.
        paths = stage(self.paths.read(before).join(named, "path_lower", "left_semi"), "paths")
        ids = events.where(F.col("kind") == "file").select(P.clean_id(F.col("raw_id")).alias("file_id")).unionByName(paths.select("file_id"))
        revs = stage(self.revs.read(before).join(ids.distinct(), "file_id", "left_semi"), "revs")
        rows, paired = self._paired(events, paths, revs)
        failed = None
        if paired:
            marked = stage(classify(events, paths.join(revs, "file_id"), self.max_group, rows=rows), "judged")
            if fetch:
                marked, failed = self._fetched_by_path(fetch, marked, paths, revs, rows)
            new_paths, new_revs = self._left(marked)
        else:
            judged = self._replayed(events, paths, revs, None)
            if fetch:
                judged, failed = self._fetched(fetch, judged, events, paths, revs)
            marked, new_paths, new_revs = judged
        if fetch:
            self._keep_waiting(marked, failed, before, batch_id)
        owned = (F.col("kind") == "deleted") | F.col("ok")
        effect = skew.latest(marked.where(owned), "path_lower", "seq").withColumn("removed", F.col("kind") == "deleted")
        folders = batch.where(F.col("kind") == "folder").select(F.lit("folder").alias("outcome"))
        totals = marked.select("outcome").unionAll(folders).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
        if self.mirror:
            effect = stage(effect, "effect")
            totals = totals.unionByName(self._follow(batch_id, marked, named, effect))
        self._write_all(
            lambda: self.paths.write(batch_id, new_paths),
            lambda: self.revs.write(batch_id, new_revs),
            lambda: self.live.write(batch_id, effect),
            *self._closing(batch, batch_id, totals),
        )
        seen = batch.select(F.col("seq").alias("cursor")).unionByName(self.cursor.read(before))
        self.cursor.write(batch_id, seen.agg(F.max("cursor").alias("cursor")), full=True)

    @staticmethod
    def _write_all(*writes: Callable[[], None]) -> None:
        """Small tables that do not depend on one another, side by side."""
        with ThreadPoolExecutor(len(writes)) as pool:
            for done in [pool.submit(write) for write in writes]:
                done.result()

    def _replayed(self, events: DataFrame, paths: DataFrame, revs: DataFrame, failed: DataFrame | None):
        """``(events with outcome, changes of paths, of revisions)``; ``failed`` events are not taken in."""
        if failed is not None:
            marks = failed.select("seq").distinct().withColumn("failed", F.lit(True))
            events = events.join(marks, "seq", "left").withColumn("failed", F.coalesce("failed", F.lit(False)))
        settled = replay.replay(events, paths, revs, self.max_group)
        own = settled.where(~F.col("kind").startswith("seed"))
        marked = enrich(events)
        taken = acceptable() & not_failed(marked)
        result = F.col("outcome") if failed is None else F.when(F.col("failed"), "skipped").otherwise(F.col("outcome"))
        marked = marked.withColumn("ok", taken).join(own.select("seq", "outcome"), "seq").withColumn("outcome", result)
        new_paths = _changes(paths, replay.final_paths(settled), "path_lower")
        return stage(marked, "judged"), new_paths, _changes(revs, replay.final_revs(settled), "file_id")

    @staticmethod
    def _left(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Changes of paths and of revisions by paired events."""
        removed = F.col("kind") == "deleted"
        settled = marked.where(F.col("outcome").isin(*TAKEN, "deleted", "archive_deleted")).withColumn("removed", removed)
        # An archive deleted once more holds no id; the deletion before that is what ends its revision.
        named = settled.where(~removed | F.col("prev_id").isNotNull())
        owner = F.when(F.col("removed"), F.col("prev_id")).otherwise(F.col("file_id"))
        revs = skew.latest(named, "path_lower", "seq").withColumn("file_id", owner).where(F.col("file_id").isNotNull())
        return skew.latest(settled, "path_lower", "seq"), revs

    def _paired(self, events: DataFrame, paths: DataFrame, revs: DataFrame) -> tuple[int, bool]:
        """Rows of events and state, and whether each path and id among them has one partner, so that a path's history decides."""
        ident = F.when(F.col("kind") == "file", P.clean_id(F.col("raw_id"))).alias("file_id")
        # An id on record that none of these paths holds has a partner elsewhere.
        nowhere = F.lit(None).cast("string").alias("path_lower")
        links = (
            events.select("path_lower", ident, F.lit(False).alias("kept"))
            .unionAll(paths.select("path_lower", "file_id", F.lit(True)))
            .unionAll(revs.select(nowhere, "file_id", F.lit(True)))
            .groupBy("path_lower", "file_id").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept"))
        )
        held = F.col("path_lower").isNotNull() & F.col("file_id").isNotNull()
        kept = F.when(F.col("kept"), F.col("file_id"))
        rows, pairs, of_paths, of_ids, known, placed = links.agg(
            F.sum("n"), F.count_if(held), F.count_distinct(F.when(held, F.col("path_lower"))),
            F.count_distinct(F.when(held, F.col("file_id"))), F.count_distinct(kept), F.count_distinct(F.when(held, kept)),
        ).first()
        return rows or 0, pairs == of_paths == of_ids and known == placed

    def _fetched(self, fetch: Fetch, judged: tuple, events: DataFrame, paths: DataFrame, revs: DataFrame):
        """Fetch what is taken in. As an event that fails changes what follows it, events are judged again without it."""
        tried, failed = None, None
        while True:
            wanted = judged[0].where(F.col("outcome").isin(*TAKEN))
            if tried is not None:
                wanted = wanted.join(tried, "seq", "left_anti")
            found = stage(wanted.select("seq").join(fetch(wanted), "seq", "left"), "fetched")
            new = found.where(F.col("error").isNotNull()).select("seq", "error")
            if new.isEmpty():
                return judged, failed
            tried = found.select("seq") if tried is None else tried.unionByName(found.select("seq"))
            failed = new if failed is None else failed.unionByName(new)
            judged = self._replayed(events, paths, revs, failed)

    def _fetched_by_path(self, fetch: Fetch, marked: DataFrame, paths: DataFrame, revs: DataFrame, rows: int):
        """``_fetched`` for paired events: only paths on which an event newly failed are judged again.

        Every round is over the paths of the failures of the one before it, so all rounds together cost little more
        than the first two.
        """
        open_ = marked.withColumns({"failed": F.lit(False), "tried": F.lit(False)})
        done, failed = [], None
        while True:
            wanted = open_.where(F.col("outcome").isin(*TAKEN) & ~F.col("tried"))
            found = stage(wanted.select("seq", "path_lower").join(fetch(wanted), "seq", "left"), "fetched")
            new = found.where(F.col("error").isNotNull())
            if new.isEmpty():
                break
            failed = new.select("seq", "error") if failed is None else failed.unionByName(new.select("seq", "error"))
            # Events without a path have a history of their own.
            hit = new.select(F.col("path_lower").alias("_path")).distinct()
            of_hit = F.col("path_lower").eqNullSafe(F.col("_path"))
            done.append(open_.join(hit, of_hit, "left_anti"))
            again = open_.join(hit, of_hit, "left_semi").join(
                new.select("seq").distinct().withColumn("_new", F.lit(True)), "seq", "left"
            ).withColumns({
                "failed": F.col("failed") | F.col("_new").isNotNull(),
                "tried": F.col("tried") | F.col("outcome").isin(*TAKEN),
            }).drop("_new", "ok", "prev_rev", "prev_id", "outcome")
            prior = paths.join(hit, of_hit, "left_semi").join(revs, "file_id")
            if rows > self.max_group:
                # A path brings one row of state at most.
                rows = min(rows, 2 * open_.count())
            open_ = stage(classify(again, prior, self.max_group, rows=rows), "judged")
        if failed is None:
            return marked, None
        for part in done:
            open_ = open_.unionByName(part)
        return stage(open_.drop("tried"), "judged"), failed

    def _keep_waiting(self, marked: DataFrame, failed: DataFrame | None, before: int, batch_id: int) -> None:
        """A failed event waits for the next batch, unless a later one of its path took effect."""
        errors = failed if failed is not None else marked.limit(0).select("seq", F.lit("").alias("error"))
        marked = marked.join(errors, "seq", "left")
        tried = F.col("outcome").isin(*TAKEN) | (F.col("kind") == "deleted") | F.col("error").isNotNull()
        waiting = skew.latest(marked.where(tried), "path_lower", "seq").where(F.col("error").isNotNull())
        waiting = stage(waiting.withColumn("attempts", F.col("attempts") + 1), "waiting")
        waiting = waiting.select(*_RETRY.fieldNames(), F.lit(False).alias("removed"))
        # Everything tried before and not waiting now has been settled or superseded.
        closed = self.retry.read(before).join(waiting.select("path_lower"), "path_lower", "left_anti")
        self.retry.write(batch_id, waiting.unionByName(closed.withColumn("removed", F.lit(True))))

    def _follow(self, batch_id: int, marked: DataFrame, named: DataFrame, effect: DataFrame) -> DataFrame:
        """Objects and sidecars of the files that this batch touched; the counters of members."""
        before = batch_id - 1
        live = self.live.read(before)
        was = stage(live.join(named, "path_lower", "left_semi"), "was")
        behind = stage(self.behind.read(before), "behind")
        ids = was.select("file_id").unionByName(effect.where(~F.col("removed")).select("file_id")).unionByName(behind.select("file_id"))
        ids = stage(ids.distinct(), "touched")
        # A file may be owned by paths outside the batch too.
        elsewhere = live.join(named, "path_lower", "left_anti").join(ids, "file_id", "left_semi")
        stays = was.join(effect.select("path_lower"), "path_lower", "left_anti")
        now = effect.where(~F.col("removed")).select(*_LIVE.fieldNames()).unionByName(stays).unionByName(elsewhere)
        desired = skew.latest(now, "file_id", "seq")
        key = P.object_key(F.col("category"), F.col("file_id"), F.col("ext"))
        fetched = marked.where(F.col("outcome") == "synced").select(
            "file_id", F.col("path_display").alias("path"), P.object_uri(self.mirror.root, key).alias("object_uri")
        )
        changes = mirroring.follow(self.mirror, ids, desired, self.items.read(before), behind, fetched)
        self.items.write(batch_id, changes.items)
        self.behind.write(batch_id, changes.behind)
        so_far = self.queued.read(before).agg(F.max("total")).first()[0] or 0
        numbered = imports.row_index(changes.documents.withColumnRenamed("object_uri", "uri").distinct(), "uri")
        self.queue.write(batch_id, numbered.withColumn("position", F.col("idx") + so_far))
        total = self.queue.read_version(batch_id).agg((F.count(F.lit(1)) + so_far).alias("total"))
        self.queued.write(batch_id, total, full=True)
        return changes.counts

    def _closing(self, batch: DataFrame, batch_id: int, totals: DataFrame) -> list[Callable[[], None]]:
        """Writes of the size and the counters of the batch."""
        size = batch.agg(F.count(F.lit(1)).alias("n")).select(F.lit(batch_id).cast("bigint").alias("batch"), "n")
        sums = self.counts.read(batch_id - 1).unionByName(totals).groupBy("outcome").agg(F.sum("n").alias("n"))
        return [lambda: self.batches.write(batch_id, size), lambda: self.counts.write(batch_id, sums, full=True)]


def _changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` that are not in ``old``, and the keys that are gone."""
    gone = old.join(new.select(key), key, "left_anti").withColumn("removed", F.lit(True))
    return new.join(old, new.columns, "left_anti").withColumn("removed", F.lit(False)).unionByName(gone)


# The job takes feeds in which files move; the name remains for callers of the former split.
MovingSyncJob = SyncJob
