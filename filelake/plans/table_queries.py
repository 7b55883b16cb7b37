"""Queries that go through files: sinks, state tables, objects, ZIP files and streams."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from filelake import constants as C
from filelake import schemas
from filelake.functions import paths as P
from filelake.operators import archive, catalog
from filelake.operators.imports import manifest
from filelake.plans import inputs as I
from filelake.plans.registry import query
from filelake.session import new_folder, spread_paths
from filelake.sources import objects, sidecar
from filelake.sources.state import StateTable
from filelake.streaming.sync import SyncJob

_META = "file_id, path, rev, mime_type, size, server_modified, category, object_uri, caption"


# --- sidecars, catalog and state ---------------------------------------------------------------


@query("write_meta", f"select {_META} from meta")
def write_meta(spark, sf):
    folder = new_folder(spark, "meta")
    sidecar.write_sidecars(I.meta(spark, sf), folder)
    return sidecar.read_sidecars(spark, folder).drop("source_zip", "extracted_count")


@query("meta_scan", """
select file_id, rev, category, extracted_count from (
  select file_id, rev, category, cast(null as bigint) as extracted_count from meta where true
  union all select l.file_id, l.rev, 'archive', coalesce(t.n_members, 0)
  from live l left join member_totals t on l.file_id = t.file_id where l.archive
  union all select file_id, rev, category, null from expanded)""")
def meta_scan(spark, sf):
    """Sidecars of files, members and archives, written as JSON and scanned together."""
    folder = new_folder(spark, "meta")
    sidecar.write_sidecars(I.catalog(spark, sf), folder)
    return sidecar.read_sidecars(spark, folder).select("file_id", "rev", "category", "extracted_count")


@query("write_catalog", "select file_id, object_key, size as length, category from stored_meta")
def write_catalog(spark, sf):
    folder = new_folder(spark, "catalog")
    sidecar.write_catalog(I.objects(spark, sf).drop("object_uri"), folder)
    return spark.read.parquet(folder)


@query("write_manifest", r"""
select '{"id":"' || regexp_extract(split_part(uri, '/', -1), '(?s)\A(.*?[^./][^/]*)(\.[^./]*)\z', 1)
  || '","content":{"mimeType":"' || coalesce(mime, 'application/octet-stream') || '","uri":"' || uri || '"}}' as value
from doc_uris left join ext_dim on lower(regexp_extract(uri, '(\.[^./]*)$', 1)) = ext""")
def write_manifest(spark, sf):
    folder = new_folder(spark, "manifest")
    sidecar.write_lines(manifest(I.doc_uris(spark, sf)).select("line"), folder)
    return spark.read.text(folder)


def _state(spark, sf):
    """Revisions on record as version 0, then the live files as version 1, gone ids removed."""
    table = StateTable(spark, new_folder(spark, "revs"), "file_id", schemas.REV_INDEX)
    old, now = I.rev_index(spark, sf), I.live(spark, sf).select("file_id", "rev")
    table.write(0, old, full=True)
    gone = old.join(now.select("file_id"), "file_id", "left_anti")
    table.write(1, now.withColumn("removed", F.lit(False)).unionByName(gone.withColumn("removed", F.lit(True))))
    return table


@query("state_load", "select file_id, rev from live")
def state_load(spark, sf):
    return _state(spark, sf).read()


@query("write_state", "select file_id, rev from live")
def write_state(spark, sf):
    """The same after all deltas were folded into one snapshot."""
    table = _state(spark, sf)
    table.compact()
    return table.read()


@query("resync", f"""
select cast(null as bigint) as cursor, file_id, rev from all_revs where file_id in (
  select file_id from stored_meta where category = 'images' or category = 'docs')""")
def resync(spark, sf):
    """Re-scan on demand: only valid revisions stay on record, and the cursor is cleared."""
    revs = StateTable(spark, new_folder(spark, "revs"), "file_id", schemas.REV_INDEX)
    cursor = StateTable(spark, new_folder(spark, "cursor"), "cursor", schemas.SYNC_STATE)
    revs.write(0, I.all_revs(spark, sf), full=True)
    cursor.write(0, I.previous_cursor(spark, sf), full=True)
    keep = catalog.valid_ids(I.objects(spark, sf).select("object_uri"))
    revs.write(1, catalog.resync_keep(revs.read(), keep), full=True)
    cursor.write(1, cursor.read().limit(0), full=True)
    saved = cursor.read().agg(F.max("cursor")).scalar()
    return revs.read().select(saved.alias("cursor"), "file_id", "rev")


# --- objects and ZIP files ---------------------------------------------------------------------


@query("object_digest")
def object_digest(spark, sf):
    """Length and sha256 of the given table files themselves."""
    listed = objects.list_objects(spark, sf, "*.parquet")
    found = objects.digests(listed).join(listed, "path")
    return found.select(P.basename(F.col("path")).alias("name"), "length", "n_bytes", "sha256", "error")


def _zip_documents(spark, sf, broken: bool = False):
    """Every document as a text file in ZIP archives that the tasks write, 50 to an archive.

    With ``broken``, archives whose first document is English lose their end.
    """
    folder = new_folder(spark, "zips")

    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, len(batch), 50):
                rows = batch.iloc[start : start + 50]
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as out:
                    out.writestr("__MACOSX/skip.txt", "x")
                    out.writestr("src/", "")
                    for doc_id, text in rows[["doc_id", "text"]].itertuples(index=False):
                        out.writestr(f"src/{doc_id}.txt", text)
                        out.writestr(f"src/.{doc_id}.txt", text)
                        out.writestr(f"src/{doc_id}.exe", "x")
                content = buffer.getvalue()
                corrupt = broken and rows["lang"].iloc[0] == "en"
                path = f"{folder}/{part}-{n}.zip"
                objects.put(path, content[: len(content) // 2] if corrupt else content)
                yield pd.DataFrame({"path": [path], "n_docs": [len(rows)], "corrupt": [corrupt]})
                n += 1

    d = I.table(spark, sf, "documents").select("doc_id", "text", "lang")
    written = d.mapInPandas(run, "path string, n_docs bigint, corrupt boolean")
    # Written as a table at once: the archives must not be made again by a second scan.
    listing = new_folder(spark, "zip-list")
    written.write.parquet(listing)
    return spark.read.parquet(listing)


@query("archive_files", """
select doc_id || '.txt' as filename, 'docs' as category, cast(octet_length(encode(text)) as bigint) as n_bytes,
  sha256(text) as sha256 from documents""")
def archive_files(spark, sf):
    members = objects.zip_members(_zip_documents(spark, sf))
    return members.select(P.basename(F.col("inner_path")).alias("filename"), "category", "n_bytes", "sha256")


@query("archive_directory", """
select 'src/' || doc_id || '.txt' as inner_path, cast(octet_length(encode(text)) as bigint) as file_size from documents
union all select 'src/' || doc_id || '.exe', 1 from documents""")
def archive_directory(spark, sf):
    """Visible entries by the archives' own directories."""
    zips = _zip_documents(spark, sf).withColumn("file_id", P.uri_id(F.col("path")))
    return archive.visible_members(objects.manifest(zips)).select("inner_path", "file_size")


def _stored(spark, folder):
    listed = objects.list_objects(spark, folder)
    found = objects.digests(listed).where(F.col("error").isNull())
    return found.select(P.basename(F.col("path")).alias("name"), "n_bytes", "sha256")


@query("archive_unpack", """
select doc_id || '.txt' as name, cast(octet_length(encode(text)) as bigint) as n_bytes, sha256(text) as sha256
from documents""")
def archive_unpack(spark, sf):
    """Documents unpacked from the archives into the mirror, read back from there."""
    folder = new_folder(spark, "mirror")
    members = objects.zip_members(_zip_documents(spark, sf))
    target = F.concat(F.lit(folder + "/mirror/docs/"), P.basename(F.col("inner_path")))
    done = objects.unpack(members.select("path", "inner_path", "pos", target.alias("target")))
    done.write.parquet(new_folder(spark, "unpacked"))
    return _stored(spark, folder)


@query("mirror_objects", """
select doc_id || '.txt' as name, cast(octet_length(encode(text)) as bigint) as n_bytes, sha256(text) as sha256
from documents""")
def mirror_objects(spark, sf):
    """Documents written as source objects, copied into the mirror and read back from there."""
    source, folder = new_folder(spark, "source"), new_folder(spark, "mirror")

    def run(batches):
        with objects.Writer() as write:
            for batch in batches:
                paths = [f"{source}/{doc_id}.txt" for doc_id in batch["doc_id"]]
                for path, text in zip(paths, batch["text"]):
                    write.put(path, text.encode("utf-8"))
                yield pd.DataFrame({"source": paths})

    listing = new_folder(spark, "sources")
    I.table(spark, sf, "documents").select("doc_id", "text").mapInPandas(run, "source string").write.parquet(listing)
    copies = spark.read.parquet(listing).withColumn(
        "target", F.concat(F.lit(folder + "/mirror/docs/"), P.basename(F.col("source")))
    )
    objects.mirror(copies).write.parquet(new_folder(spark, "copied"))
    return _stored(spark, folder)


@query("remove_objects", """
select doc_id || '.txt' as name, cast(octet_length(encode(text)) as bigint) as n_bytes, sha256(text) as sha256
from documents where doc_id not in (select doc_id from labels)""")
def remove_objects(spark, sf):
    """The mirror after the labelled documents' objects were deleted, twice over."""
    folder = new_folder(spark, "mirror")

    def run(batches):
        with objects.Writer() as write:
            for batch in batches:
                paths = [f"{folder}/mirror/docs/{doc_id}.txt" for doc_id in batch["doc_id"]]
                for path, text in zip(paths, batch["text"]):
                    write.put(path, text.encode("utf-8"))
                yield pd.DataFrame({"path": paths})

    stored = I.table(spark, sf, "documents").select("doc_id", "text").mapInPandas(run, "path string")
    stored.write.parquet(new_folder(spark, "stored"))
    name = F.concat(F.lit(f"{folder}/mirror/docs/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    gone = I.table(spark, sf, "labels").select(name.alias("path"))
    for label in ("removed", "removed-again"):
        objects.remove(gone).write.parquet(new_folder(spark, label))
    return _stored(spark, folder)


@query("archive_errors")
def archive_errors(spark, sf):
    """Archives with what they should and do hold: a corrupt one gives no members but an error."""
    archives = _zip_documents(spark, sf, broken=True)
    entries = objects.zip_entries(archives)
    found = entries.groupBy("path").agg(
        F.count_if(F.col("error").isNotNull()).alias("errors"),
        F.count_if(F.col("inner_path").isNotNull()).alias("entries"),
    )
    return archives.join(found, "path").select("n_docs", "corrupt", "errors", "entries")


# --- streams -----------------------------------------------------------------------------------


def _slices(c):
    """A feed in thirds of the month, as it arrives run by run."""
    day = F.day("server_modified")
    return [c.where(day <= 10), c.where((day > 10) & (day <= 20)), c.where(day > 20)]


def _run_slices(spark, sf, job, feed):
    sizes = []
    for part in _slices(I.changes(spark, sf)):
        part.write.mode("append").parquet(feed)
        sizes.append(sum(job.run(feed)))
        sizes.append(sum(job.run(feed)))
    return sizes


_FOLDED = """
select path_lower, file_id, rev, category from live"""


@query("stream_incremental", """
with s as (select case when day(server_modified) <= 10 then 0 when day(server_modified) <= 20 then 2 else 4 end as run,
    seq from changes)
select cast(run as bigint) as run, count(*) as n_events from s group by run
union all select cast(range as bigint) * 2 + 1, 0 from range(3)""")
def stream_incremental(spark, sf):
    """Events taken by six runs: each third of the feed, and after each a run with nothing new."""
    job = SyncJob(spark, new_folder(spark, "sync"))
    feed = new_folder(spark, "feed")
    sizes = _run_slices(spark, sf, job, feed)
    return spark.createDataFrame(list(enumerate(sizes)), "run bigint, n_events bigint")


@query("stream_fold", _FOLDED)
def stream_fold(spark, sf):
    job = SyncJob(spark, new_folder(spark, "sync"))
    _run_slices(spark, sf, job, new_folder(spark, "feed"))
    return job.live.read().select("path_lower", "file_id", "rev", "category")


@query("stream_counts", "select outcome, cast(count(*) as bigint) as n from outcomes group by outcome")
def stream_counts(spark, sf):
    """Outcome counters summed over the micro-batches: the same as those of one batch run."""
    job = SyncJob(spark, new_folder(spark, "sync"))
    _run_slices(spark, sf, job, new_folder(spark, "feed"))
    return job.counts.read()


@query("stream_bounded", """
select cast(count(*) as bigint) as batches, cast(sum(n) as bigint) as events, max(n) as largest from (
  select count(*) as n from changes group by dayofweek(server_modified))""")
def stream_bounded(spark, sf):
    """One run over a feed of many files, one to a batch: every batch is in the list it returns."""
    job, feed = SyncJob(spark, new_folder(spark, "sync")), new_folder(spark, "feed")
    c, day = I.changes(spark, sf), F.dayofweek("server_modified")
    # At most eight days, no day among them. Each is written as it is read: sorting by day would hold them all in one task.
    for (found,) in c.select(day).distinct().collect():
        c.where(day.eqNullSafe(F.lit(found))).coalesce(1).write.parquet(f"{feed}/day={found}")
    sizes = job.run(f"{feed}/day=*", max_files=1)
    rows = spark.createDataFrame([(n,) for n in sizes], "n bigint")
    return rows.agg(F.count("n").alias("batches"), F.sum("n").alias("events"), F.max("n").alias("largest"))


@query("stream_replay", _FOLDED)
def stream_replay(spark, sf):
    """Every batch delivered twice, the second time after its commit was lost."""
    job = SyncJob(spark, new_folder(spark, "sync"))
    for number, part in enumerate(_slices(I.changes(spark, sf))):
        job.apply(part, number)
        job.apply(part, number)
        job.apply(part, number, again=True)
    return job.live.read().select("path_lower", "file_id", "rev", "category")


def _moving_state(spark, feed):
    job = SyncJob(spark, new_folder(spark, "sync"))
    for number, part in enumerate(_slices(feed)):
        job.apply(part, number)
    return job.paths.read().join(job.revs.read(), "file_id", "left").select("path_lower", "file_id", "rev")


@query("stream_moves", """
select p.path_lower, p.file_id, r.rev from replayed_paths p left join replayed_revs r using (file_id)""")
def stream_moves(spark, sf):
    """Paths, ids and revisions after three batches of a feed in which files move."""
    return _moving_state(spark, I.moves(spark, sf))


@query("stream_moves_paired", "select path_lower, file_id, rev from live")
def stream_moves_paired(spark, sf):
    """On a feed of paired paths and ids what is left is the folded state."""
    return _moving_state(spark, I.changes(spark, sf))


@query("failed_not_committed", _FOLDED)
def failed_not_committed(spark, sf):
    """Every media file of the first twenty days fails at first and is stored by a later batch."""

    def fetch(attempted):
        flaky = (F.col("category") == "media") & (F.day("server_modified") <= 20) & (F.col("attempts") == 0)
        return attempted.select("seq", F.when(flaky, "read timed out").alias("error"))

    job = SyncJob(spark, new_folder(spark, "sync"), fetch=fetch)
    _run_slices(spark, sf, job, new_folder(spark, "feed"))
    return job.live.read().select("path_lower", "file_id", "rev", "category")


@query("stream_ownership", "select path_lower, file_id, rev, category from moved_live")
def stream_ownership(spark, sf):
    """Files at the paths that own them after three batches of a feed in which files move."""
    job = SyncJob(spark, new_folder(spark, "sync"))
    for number, part in enumerate(_slices(I.moves(spark, sf))):
        job.apply(part, number)
    return job.files().select("path_lower", "file_id", "rev", "category")


# What every plain source file holds.
_PLAIN = b"content"


def _source_files(spark, sf, feed, source, spoil=0, without=None):
    """A source file for every path of ``feed``: plain ones, and archives that share out all documents.

    With ``spoil`` 1, every second archive loses its end and the others' first member is damaged. Documents in the
    language ``without`` are left out.
    """
    paths = feed.where("kind = 'file'").select("path_lower", "path_display").distinct()
    zips = paths.where(F.col("path_lower").endswith(".zip"))
    zips = zips.withColumn("box", F.row_number().over(Window.orderBy("path_lower")) - 1)
    docs = I.table(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars")
    if without:
        docs = docs.where(F.col("lang") != without)
    inner = F.concat(F.lit("src/"), F.col("doc_id").cast("string"), I.slot(F.col("n_chars")))
    number = zips.agg(F.greatest(F.count(F.lit(1)), F.lit(1))).scalar()
    members = docs.select(inner.alias("inner_path"), "text", (F.col("doc_id") % number).cast("int").alias("box"))

    def pack(key, rows):
        place = source + rows["path_display"].iloc[0]
        buffer = io.BytesIO()
        named = rows.dropna(subset=["inner_path"]).sort_values("inner_path")
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED) as out:
            for name, text in named[["inner_path", "text"]].itertuples(index=False):
                out.writestr(name, text)
        content = bytearray(buffer.getvalue())
        if spoil and key[0] % 2:
            content = content[: len(content) // 2]
        elif spoil and len(named):
            # The first content byte after the first local header.
            content[30 + len(named["inner_path"].iloc[0].encode())] ^= 1
        objects.put(place, bytes(content))
        return pd.DataFrame({"path": [place]})

    def plain(batches):
        with objects.Writer() as write:
            for batch in batches:
                for path in batch["path_display"]:
                    write.put(source + path, _PLAIN)
                yield pd.DataFrame({"path": source + batch["path_display"]})

    made = zips.join(members, "box", "left").groupBy("box").applyInPandas(pack, "path string")
    # Dealt out: adaptive merging would leave such small rows, and all the files, to one task.
    files = spread_paths(paths.where(~F.col("path_lower").endswith(".zip")).select("path_display")).mapInPandas(plain, "path string")
    made.unionAll(files).write.parquet(new_folder(spark, "sources"))


def _mirror_job(spark, sf, feed, name="sync", spoil=0):
    folder = new_folder(spark, "lake")
    source, lake = f"{folder}/source", f"{folder}/lake"
    _source_files(spark, sf, feed, source, spoil)
    return SyncJob(spark, f"{folder}/{name}", mirror=objects.Mirror(source, lake)), source, lake


def _listing(spark, lake):
    """Objects of the mirror, without the sidecars."""
    found = objects.list_objects(spark, f"{lake}/mirror").where(~F.col("path").contains("/mirror/meta/"))
    return found.select(F.concat(F.lit("mirror/"), F.substring_index("path", "/lake/mirror/", -1)).alias("object_key"), "length")


_PLAIN_KEYS = """
select prefix || file_id || case when category = 'docs' then ext else '' end as object_key, cast(7 as bigint) as length
from {live} where not archive"""
_MEMBER_KEYS = """
select prefix || file_id || suffix as object_key, n_bytes as length from box_members"""


@query("stream_deletes", _PLAIN_KEYS.format(live="moved_live") + """
union all
select m.prefix || l.file_id || '___' || inner_id || suffix, n_bytes
from moved_live l join moved_boxes b on l.path_lower = b.path_lower
  join boxed m on m.doc_id % (select count(*) from moved_boxes) = b.box""")
def stream_deletes(spark, sf):
    """Objects left in the mirror by a feed in which files move, change their type and end, archives among them."""
    feed = I.moves(spark, sf)
    job, _, lake = _mirror_job(spark, sf, feed)
    for number, part in enumerate(_slices(feed)):
        job.apply(part, number)
    return _listing(spark, lake)


@query("stream_archives", """
select file_id, zip_id, path, rev, category, n_bytes as size from box_members""")
def stream_archives(spark, sf):
    """Members on record after the whole feed came in one run, without those that broke off before."""
    feed = I.changes(spark, sf)
    job, _, _ = _mirror_job(spark, sf, feed)
    job.apply(feed, 0)
    return job.items.read().where("zip_id is not null").select("file_id", "zip_id", "path", "rev", "category", "size")


@query("stream_archive_retry", _PLAIN_KEYS.format(live="live") + "\nunion all\n" + _MEMBER_KEYS)
def stream_archive_retry(spark, sf):
    """The mirror after half of the archives were cut off and a member of the others damaged, and all were mended."""
    feed = I.changes(spark, sf)
    job, source, lake = _mirror_job(spark, sf, feed, spoil=1)
    job.apply(feed, 0)
    _source_files(spark, sf, feed, source)
    job.apply(feed.limit(0), 1)
    return _listing(spark, lake)


@query("stream_archive_update", """
with latest as (
  select o.file_id, max(c.server_modified) as read_at from outcomes o join changes c using (seq)
  where o.outcome = 'archive' group by o.file_id
)
select m.file_id, m.zip_id, m.path, m.rev, m.category, m.n_bytes as size
from box_members m join latest on latest.file_id = m.zip_id where day(read_at) <= 20 or lang <> 'en'""")
def stream_archive_update(spark, sf):
    """Members after the archives lost their English documents before the last third of the feed."""
    feed = I.changes(spark, sf)
    job, source, _ = _mirror_job(spark, sf, feed)
    for number, part in enumerate(_slices(feed)):
        if number == 2:
            _source_files(spark, sf, feed, source, without="en")
        job.apply(part, number)
    return job.items.read().where("zip_id is not null").select("file_id", "zip_id", "path", "rev", "category", "size")


@query("stream_bootstrap", """
select file_id, path_display as path, rev, case when archive then 'archive' else category end as category from live where true
union all select file_id, path, rev, category from box_members""")
def stream_bootstrap(spark, sf):
    """Everything on record where the state was lost before the last third of the feed and rebuilt from sidecars."""
    feed = I.changes(spark, sf)
    job, source, lake = _mirror_job(spark, sf, feed, "lost")
    parts = _slices(feed)
    for number, part in enumerate(parts[:2]):
        job.apply(part, number)
    again = SyncJob(spark, new_folder(spark, "again"), mirror=job.mirror)
    again.bootstrap(sidecar.read_sidecars(spark, f"{lake}/mirror/meta"))
    again.apply(parts[2], 0)
    return again.items.read().select("file_id", "path", "rev", "category")


@query("stream_imports", f"""
with thirds as (
  select *, case when day(server_modified) <= 10 then 0 when day(server_modified) <= 20 then 1 else 2 end as third from ev
), ends as (
  select k.third, t.file_id, t.path_lower, t.kind, t.category, t.prefix, t.ext, t.archive, t.rev,
    row_number() over (partition by k.third, t.path_lower order by t.seq desc) as rn
  from thirds t, (select unnest([0, 1, 2]) as third) k where (t.ok or t.kind = 'deleted') and t.third <= k.third
), stored as (
  select e.* from ends e semi join (
    select t.third, o.file_id from outcomes o join thirds t using (seq) where o.outcome in ('synced', 'archive')
  ) n on e.third = n.third and e.file_id = n.file_id
  anti join ends b on e.archive and b.rn = 1 and b.kind = 'file' and b.third = e.third - 1 and b.file_id = e.file_id and b.rev = e.rev
  where e.rn = 1 and e.kind = 'file'
), documents_of as (
  select third, prefix || file_id || ext as object_key from stored where category = 'docs'
  union all
  select s.third, m.prefix || s.file_id || '___' || m.inner_id || m.suffix from stored s
    join boxes b on s.path_lower = b.path_lower join boxed m on m.doc_id % (select count(*) from boxes) = b.box
  where s.archive and m.category = 'docs'
), numbered as (
  select object_key, row_number() over (order by third, object_key) - 1 as position from documents_of
)
select cast(position // {C.IMPORT_BATCH} as bigint) as batch_id, cast(position % {C.IMPORT_BATCH} as bigint) as place, object_key
from numbered""")
def stream_imports(spark, sf):
    """Import requests of three runs: their numbers go on from run to run, also when a run is delivered again."""
    feed = I.changes(spark, sf)
    job, _, lake = _mirror_job(spark, sf, feed)
    for number, part in enumerate(_slices(feed)):
        job.apply(part, number)
    job.apply(part, number, again=True)
    places = job.import_requests().select("batch_id", F.posexplode("uris").alias("at", "uri"))
    key = F.concat(F.lit("mirror/"), F.substring_index("uri", "/lake/mirror/", -1))
    return places.select("batch_id", F.col("at").cast("bigint").alias("place"), key.alias("object_key"))
